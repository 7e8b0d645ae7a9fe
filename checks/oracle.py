"""SQL that states what each query must return, for an independent engine.

The fragments are assembled with plain string functions; nothing here is used
by the library itself.
"""

from __future__ import annotations

from ringlens import constants
from ringlens.constants import FEATURE_COLUMNS
from ringlens.config import RiskConfig

from checks import adapters

# Four-digit prefixes as they stand after cleaning; they match the adapter's numbers.
TEST_PROVIDERS = {
    "viettel": ["9800", "9700", "0977", "8600"],
    "mobi": ["0901"],
    "vina": ["0912", "8800"],
}


def quoted(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def dimension() -> str:
    rows = ", ".join(f"('{p}', '{name}')" for name, owned in TEST_PROVIDERS.items() for p in owned)
    return f"(SELECT * FROM (VALUES {rows}) v(prefix, provider))"


def bare(column: str) -> str:
    """A number without + and without 84."""
    plus = f"CASE WHEN {column} LIKE '+%' THEN substr({column}, 2) ELSE {column} END"
    return f"CASE WHEN ({plus}) LIKE '84%' THEN substr({plus}, 3) ELSE {plus} END"


def office_days(days: tuple[int, ...]) -> str:
    return ", ".join(str(day + 1) for day in days)


def clean(history: str) -> str:
    return f"""
    SELECT * FROM (
      SELECT {bare('phone')} AS phone, {bare('phone_member')} AS phone_member, report,
        CAST(type AS INTEGER) AS type, time, CAST(in_contact AS DOUBLE) AS in_contact,
        CAST(duration AS DOUBLE) AS duration, CAST(Spam AS INTEGER) AS Spam
      FROM ({history}) raw
    ) t
    WHERE type BETWEEN 1 AND 4 AND time IS NOT NULL AND report IS NOT NULL
      AND in_contact IS NOT NULL AND duration IS NOT NULL AND Spam IS NOT NULL
      AND regexp_full_match(phone, '[0-9]{{4,18}}') AND regexp_full_match(phone_member, '[0-9]{{4,18}}')
    """


def providers_of(history: str) -> str:
    return f"""
    SELECT c.*, coalesce(a.provider, 'others') AS caller_provider, coalesce(b.provider, 'others') AS receiver_provider
    FROM ({clean(history)}) c
    LEFT JOIN {dimension()} a ON a.prefix = left(c.phone, 4)
    LEFT JOIN {dimension()} b ON b.prefix = left(c.phone_member, 4)
    """


def enrich(history: str, days: tuple[int, ...] = (0, 1, 2, 3, 4)) -> str:
    return f"""
    SELECT report, phone, phone_member, type, time, in_contact, duration, Spam,
      caller_provider = receiver_provider AS same_network,
      office AS in_hour, NOT office AS not_in_hour, duration > 20 AS success,
      CAST(type = 1 AS INTEGER) AS call_to, CAST(type = 2 AS INTEGER) AS call_in,
      CAST(type = 3 AS INTEGER) AS call_to_miss, CAST(type = 4 AS INTEGER) AS call_in_miss,
      CASE WHEN type = 2 THEN duration ELSE 0 END AS duration_call_in,
      CASE WHEN type = 1 THEN duration ELSE 0 END AS duration_call_to
    FROM (
      SELECT *, isodow(time) IN ({office_days(days)}) AND hour(time) >= 7 AND hour(time) < 20 AS office
      FROM ({providers_of(history)}) p
    ) o
    """


def gaps(history: str) -> str:
    order = "ORDER BY time, phone_member, type, duration"
    return f"""
    SELECT *,
      date_diff('second', lag(time) OVER (PARTITION BY report {order}), time) AS gap,
      date_diff('second', lag(time) OVER (PARTITION BY report, outgoing {order}), time) AS way_gap,
      date_diff('second', lag(time) OVER (PARTITION BY report, outgoing, phone_member {order}), time) AS member_gap,
      lag(phone_member) OVER (PARTITION BY report {order}) AS previous_member
    FROM (SELECT *, type % 2 = 1 AS outgoing FROM ({enrich(history)}) e) d
    """


def aggregates(history: str) -> str:
    return f"""
    SELECT a.*, coalesce(m.to_hours, 0) AS total_frequency_to_by_phonemember,
      coalesce(m.in_hours, 0) AS total_frequency_in_by_phonemember
    FROM (
      SELECT report, avg(in_contact) AS avg_in_contact, avg(CAST(same_network AS INTEGER)) AS same_network,
        sum(duration) AS duration, sum(duration_call_to) AS duration_call_to,
        sum(duration_call_in) AS duration_call_in,
        CAST(count(*) FILTER (WHERE in_hour) AS BIGINT) AS in_hour,
        CAST(count(*) FILTER (WHERE not_in_hour) AS BIGINT) AS not_in_hour,
        avg(CAST(success AS INTEGER)) AS avg_success,
        CAST(sum(call_to) AS BIGINT) AS call_to, CAST(sum(call_in) AS BIGINT) AS call_in,
        CAST(sum(call_to_miss) AS BIGINT) AS call_to_miss, CAST(sum(call_in_miss) AS BIGINT) AS call_in_miss,
        max(Spam) AS Spam,
        coalesce(median(gap) / CAST(3600 AS DOUBLE), 0) AS frequency,
        coalesce(median(way_gap) FILTER (WHERE outgoing) / CAST(3600 AS DOUBLE), 0) AS total_frequency_to,
        coalesce(median(way_gap) FILTER (WHERE NOT outgoing) / CAST(3600 AS DOUBLE), 0) AS total_frequency_in,
        date_diff('second', min(time), max(time)) / CAST(3600 AS DOUBLE) AS time_join,
        count(*) FILTER (WHERE phone_member = previous_member) AS total_redial,
        count(DISTINCT phone_member) AS total_contacted,
        count(DISTINCT phone_member) FILTER (WHERE outgoing) AS total_contacted_to,
        count(DISTINCT phone_member) FILTER (WHERE NOT outgoing) AS total_contacted_in
      FROM ({gaps(history)}) g GROUP BY report
    ) a
    LEFT JOIN (
      SELECT report, sum(med) FILTER (WHERE outgoing) / CAST(3600 AS DOUBLE) AS to_hours,
        sum(med) FILTER (WHERE NOT outgoing) / CAST(3600 AS DOUBLE) AS in_hours
      FROM (
        SELECT report, outgoing, phone_member, median(member_gap) AS med
        FROM ({gaps(history)}) g GROUP BY report, outgoing, phone_member
      ) p GROUP BY report
    ) m USING (report)
    """


def with_days(history: str) -> str:
    return f"""
    SELECT a.*, d.mean_call_by_day FROM ({aggregates(history)}) a JOIN (
      SELECT report, avg(answered) AS mean_call_by_day FROM (
        SELECT report, CAST(time AS DATE) AS day, sum(call_to + call_in) AS answered
        FROM ({enrich(history)}) e GROUP BY ALL
      ) x GROUP BY report
    ) d USING (report)
    """


def over(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} = 0 THEN CAST(0 AS DOUBLE) ELSE CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) END"


def features(history: str) -> str:
    every = "(call_to + call_in + call_to_miss + call_in_miss)"
    inbound = over("(call_in + call_in_miss)", "(call_to + call_in_miss + 1)")
    whole = ["duration", "duration_call_to", "duration_call_in"]
    counts = [
        "in_hour", "not_in_hour", "call_to", "call_in", "call_to_miss", "call_in_miss", "total_redial",
        "total_contacted", "total_contacted_to", "total_contacted_in", "Spam",
    ]
    derived = {
        "call_to_rate": over("call_to", every),
        "call_in_rate": over("call_in", every),
        "call_to_miss_rate": over("call_to_miss", every),
        "call_in_miss_rate": over("call_in_miss", every),
        "callto_callin": over("call_to", "call_in"),
        "call_back_rate": over("call_to_miss", "call_in"),
        "call_miss": over("(call_to + call_in)", "(call_to_miss + call_in_miss)"),
        "sum_call": f"CAST({every} AS BIGINT)",
        "avg_duration_call_to": over("duration_call_to", "call_to"),
        "avg_duration_call_in": over("duration_call_in", "call_in"),
        "call_to_miss_mul_frequency": "call_to * frequency",
        "duration_call_to_rate": "duration_call_to / (duration_call_to + duration_call_in + 1)",
        "call_to_mul_in_contact": "call_to * avg_in_contact",
        "call_to_mul_success": "call_to * avg_success",
        "frequency_mul_in_hour": "frequency * in_hour",
        "call_to_miss_frequency_in_hour": f"({over('call_in_miss', every)}) * (frequency * in_hour)",
        "call_in_div_call_to": inbound,
        "call_in_div_call_to_mul_in_hour": f"({inbound}) * in_hour",
        "call_to_miss_rate_mul_duration_call_to": f"({over('call_to_miss', every)}) * duration_call_to",
        "frequency_in_hour_mul_duration_call_to": "frequency * in_hour * duration_call_to",
        "in_hour_mul_avg_success": "in_hour * avg_success",
        "call_in_div_call_to_mul_in_hour_mul_avg_success": f"frequency * in_hour * duration_call_to * ({inbound})",
    }
    passed = [c for c in FEATURE_COLUMNS if c not in whole and c not in counts and c not in derived]
    items = [
        "report",
        *passed,
        *[f"CAST(round_even({c}, 0) AS BIGINT) AS {c}" for c in whole],
        *[f"CAST({c} AS INTEGER) AS {c}" for c in counts],
        *[f"{sql} AS {name}" for name, sql in derived.items()],
    ]
    return f"SELECT {', '.join(items)} FROM ({with_days(history)}) agg"


INTEGER_FEATURES = [
    "duration", "duration_call_to", "duration_call_in", "in_hour", "not_in_hour", "call_to", "call_in",
    "call_to_miss", "call_in_miss", "total_redial", "total_contacted", "total_contacted_to",
    "total_contacted_in", "sum_call",
]


def phone_pool(history: str) -> str:
    sums = [
        f"CAST(sum({c}) AS BIGINT) AS {c}" if c in INTEGER_FEATURES else f"sum({c}) AS {c}"
        for c in FEATURE_COLUMNS
    ]
    return f"""
    SELECT m.phone, {', '.join(sums)}
    FROM (SELECT DISTINCT report, phone FROM ({history}) h WHERE report IS NOT NULL AND phone IS NOT NULL) m
    JOIN ({features(history)}) f USING (report) GROUP BY m.phone
    """


def clean_reports() -> str:
    return f"""
    SELECT DISTINCT phone, CASE WHEN member_id IN ('nan', 'None', 'NaT', '') THEN NULL ELSE member_id END AS member_id,
      CAST(device_report AS INTEGER) AS device_report, in_contact, report_time
    FROM ({adapters.REPORTS}) r WHERE device_report IN ('1', '2') AND in_contact IN ('no', '\\N')
    """


def report_summary(cleaned: str | None = None) -> str:
    return f"""
    SELECT phone, count(*) AS total_reports, count(*) FILTER (WHERE device_report = 1) AS spam_reports,
      count(*) FILTER (WHERE device_report = 2) AS not_spam_reports,
      count(DISTINCT member_id) FILTER (WHERE device_report = 1) AS unique_spam_members,
      count(DISTINCT member_id) FILTER (WHERE device_report = 2) AS unique_ham_members
    FROM ({cleaned or clean_reports()}) c GROUP BY phone
    """


def label_thresholds(summary: str) -> str:
    def high(column: str) -> str:
        return (
            f"CASE WHEN count(*) >= 50 THEN greatest(8, CAST(round_even(quantile_cont("
            f"CAST({column} AS DOUBLE), 0.95), 0) AS INTEGER)) ELSE 8 END"
        )

    return f"SELECT {high('spam_reports')} AS spam_high, {high('not_spam_reports')} AS ham_high FROM ({summary}) s"


def label_feedback(summary: str) -> str:
    rules = """
      CASE WHEN total_reports >= 6 AND unique_spam_members >= 3 AND spam_reports >= 5 AND spam_rate >= 0.7 THEN 1
           WHEN unique_spam_members >= 2 AND spam_reports >= spam_high AND spam_rate >= 0.6 THEN 2
           WHEN total_reports >= 6 AND unique_ham_members >= 3 AND ham_reports >= 5 AND ham_rate >= 0.7
                AND spam_reports <= 1 THEN 3
           WHEN unique_ham_members >= 2 AND ham_reports >= ham_high AND ham_rate >= 0.6 AND spam_reports = 0 THEN 4
           WHEN (spam_reports > 0 AND ham_reports > 0) OR total_reports < 3
                OR unique_spam_members + unique_ham_members < 2 THEN 5
           ELSE 6 END"""
    return f"""
    SELECT phone, total_reports, spam_reports, not_spam_reports, unique_spam_members, unique_ham_members,
      ham_reports, spam_rate, ham_rate,
      CASE WHEN rule <= 2 THEN 1 WHEN rule <= 4 THEN 0 ELSE -1 END AS label,
      ['SPAM_CONSENSUS_STRONG', 'SPAM_VOLUME_HI', 'HAM_CONSENSUS_STRONG', 'HAM_VOLUME_HI',
       'REVIEW_CONFLICT_OR_LOW_EVID', 'unknown'][rule] AS rule_id,
      ['high', 'medium', 'high', 'medium', 'low', ''][rule] AS confidence,
      CASE rule WHEN 1 THEN 'total>=6, Uspam>=3, Rspam>=5, SR>=0.7'
        WHEN 2 THEN 'Rspam>=' || spam_high || ' (p95), Uspam>=2, SR>=0.60'
        WHEN 3 THEN 'total>=6, Uham>=3, Rham>=5, HR>=0.7, spam<=1'
        WHEN 4 THEN 'Rham>=' || ham_high || ' (p95), Uham>=2, HR>=0.60, spam=0' ELSE '' END AS rule_note
    FROM (
      SELECT *, {rules} AS rule FROM (
        SELECT s.*, not_spam_reports AS ham_reports, spam_reports / CAST(total_reports AS DOUBLE) AS spam_rate,
          not_spam_reports / CAST(total_reports AS DOUBLE) AS ham_rate
        FROM ({summary}) s
      ) r, ({label_thresholds(summary)}) t
    ) v
    """


def join_key(column: str) -> str:
    text = f"trim(coalesce({column}, ''))"
    digits = f"ltrim(regexp_replace({text}, '[^0-9]', '', 'g'), '0')"
    return f"CASE WHEN {text} = '' THEN '' WHEN {digits} = '' THEN '0' ELSE {digits} END"


def changed_labels(labels: str, pool: str, rest: str) -> str:
    return f"""
    SELECT p.phone, CAST(l.label AS INTEGER) AS label, {rest} FROM ({pool}) p
    JOIN (SELECT {join_key('phone')} AS k, label FROM ({labels}) s WHERE label IN (0, 1)) l
      ON l.k = {join_key('p.phone')}
    WHERE p.label IS DISTINCT FROM l.label
    """


def sweep(scored: str) -> str:
    return f"""
    SELECT *, (tn + tp) / CAST(tn + fp + fn + tp AS DOUBLE) AS accuracy,
      CASE WHEN tp + fp = 0 THEN 0 ELSE tp / CAST(tp + fp AS DOUBLE) END AS precision,
      CASE WHEN tp + fn = 0 THEN 0 ELSE tp / CAST(tp + fn AS DOUBLE) END AS recall,
      CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) END AS f1
    FROM (
      SELECT threshold, count(*) FILTER (WHERE label = 0 AND score < threshold) AS tn,
        count(*) FILTER (WHERE label = 0 AND score >= threshold) AS fp,
        count(*) FILTER (WHERE label = 1 AND score < threshold) AS fn,
        count(*) FILTER (WHERE label = 1 AND score >= threshold) AS tp
      FROM ({scored}) s, (SELECT CAST(0.01 AS DOUBLE) + CAST(i AS DOUBLE) * CAST(0.01 AS DOUBLE) AS threshold
                          FROM range(99) r(i)) g
      GROUP BY threshold
    ) c
    """


def at_thresholds(scored: str, values: list[float]) -> str:
    grid = ", ".join(f"(CAST({v} AS DOUBLE))" for v in values)
    return sweep(scored).replace(
        "(SELECT CAST(0.01 AS DOUBLE) + CAST(i AS DOUBLE) * CAST(0.01 AS DOUBLE) AS threshold\n"
        "                          FROM range(99) r(i)) g",
        f"(VALUES {grid}) g(threshold)",
    )


def roc_auc(scored: str) -> str:
    """Rank-sum form: mean rank of the positives."""
    return f"""
    SELECT (sum(mean_rank) FILTER (WHERE label = 1) - p * (p + 1) / 2) / (p * n) AS auc FROM (
      SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / CAST(2 AS DOUBLE)
          AS mean_rank,
        CAST(sum(label) OVER () AS DOUBLE) AS p, CAST(sum(1 - label) OVER () AS DOUBLE) AS n
      FROM ({scored}) s
    ) r GROUP BY p, n
    """


def phone_origin(phone: str) -> tuple[str, str, str]:
    """(inner columns, is_international, prefix) over a row that has ``phone``."""
    inner = f"regexp_replace(trim(coalesce({phone}, '')), '[^0-9]', '', 'g') AS d"
    national = "CASE WHEN d LIKE '84%' THEN '0' || substr(d, 3) WHEN d LIKE '0%' THEN d END"
    mobiles, areas = quoted(constants.MOBILE_CODES), constants.LANDLINE_AREAS
    area3, area2 = (quoted([a for a in areas if len(a) == size]) for size in (3, 2))

    def code(text: str) -> str:
        cases = " ".join(
            f"WHEN left({text}, {size}) IN ({quoted([c for c in constants.COUNTRY_CODES if len(c) == size])}) "
            f"THEN left({text}, {size})"
            for size in (3, 2, 1)
        )
        return f"CASE {cases} ELSE left({text}, 3) END"

    kind = f"""CASE WHEN length(d) <= 5 THEN 1
      WHEN substr({national}, 2, 2) IN ({mobiles}) THEN 2
      WHEN substr({national}, 2, 3) IN ({area3}) THEN 3
      WHEN substr({national}, 2, 2) IN ({area2}) THEN 2
      WHEN d LIKE '00%' THEN 4 ELSE 5 END"""
    prefix = f"""CASE {kind} WHEN 1 THEN d WHEN 2 THEN left({national}, 3) WHEN 3 THEN left({national}, 4)
      WHEN 4 THEN {code('substr(d, 3)')} ELSE {code('d')} END"""
    return inner, f"({kind}) >= 4", prefix


def risk_features(pool: str) -> str:
    inner, foreign, prefix = phone_origin("phone")
    return f"""
    SELECT phone, score, {foreign} AS is_international, {prefix} AS prefix, CAST(sum_call AS BIGINT) AS total_call,
      CAST(call_to_miss + call_in_miss AS BIGINT) AS miss_call,
      CASE WHEN sum_call > 0 THEN duration / CAST(sum_call AS DOUBLE) ELSE 0 END AS avg_duration,
      mean_call_by_day AS frequency_per_day, call_back_rate AS callback_rate,
      not_in_hour > in_hour AS mostly_out_of_business_hour, avg_in_contact > 0 AS in_contact,
      CAST(total_contacted AS BIGINT) AS successful_call_count, avg_duration_call_in AS avg_in_duration
    FROM (SELECT *, {inner} FROM ({pool}) q) p
    """


def risk_pool() -> str:
    return f"""
    SELECT *, (CAST(right(phone, 6) AS INTEGER) % 100 + CAST(0.5 AS DOUBLE)) / 100 AS score
    FROM ({phone_pool(adapters.CALL_HISTORY)}) f
    """


def risk_levels(listed: str | None = None, pool: str | None = None, prefixes: str | None = None) -> str:
    """``prefixes`` is SQL of kind, head and place that takes the place of the two lists of prefixes."""
    config = RiskConfig()
    steps = " ".join(f"WHEN score < {limit} THEN {level}" for limit, level in config.score_levels)
    hits = " ".join(
        f"WHEN prefix LIKE '{d}%' OR phone LIKE '{d}%' THEN '{d}'" for d in config.domestic_prefixes
    )
    hit, risky = f"CASE {hits} END", f"prefix IN ({quoted(config.foreign_prefixes)})"
    if prefixes:
        hit = f"""(SELECT min({{'place': r.place, 'head': r.head}}).head FROM ({prefixes}) r WHERE r.kind = 'domestic'
          AND (starts_with(f.prefix, r.head) OR starts_with(f.phone, r.head)))"""
        risky = f"prefix IN (SELECT r.head FROM ({prefixes}) r WHERE r.kind = 'foreign')"
    c = constants

    def said(template: str, value: str) -> str:
        return "'" + template.replace("{}", f"' || {value} || '") + "'"

    return f"""
    SELECT *,
      CASE WHEN listed THEN 4 ELSE greatest(
        CASE WHEN is_international THEN CASE WHEN risky THEN 3 ELSE 2 END ELSE 0 END,
        CASE WHEN hit IS NULL THEN 0 WHEN brief THEN 3 ELSE 2 END,
        CASE WHEN missed THEN 3 ELSE 0 END, CASE WHEN busy THEN 3 ELSE 0 END,
        CASE WHEN lonely THEN 2 ELSE 0 END, CASE WHEN late THEN 2 ELSE 0 END) END AS rule_level,
      CASE WHEN listed THEN '{c.REASON_BLACKLISTED}' ELSE concat_ws(' | ',
        CASE WHEN is_international AND risky THEN {said(c.REASON_FOREIGN_RISKY, 'prefix')}
             WHEN is_international THEN '{c.REASON_FOREIGN}' END,
        CASE WHEN hit IS NOT NULL AND brief THEN {said(c.REASON_PREFIX_SHORT_CALLS, 'hit')}
             WHEN hit IS NOT NULL THEN {said(c.REASON_PREFIX, 'hit')} END,
        CASE WHEN missed THEN '{c.REASON_MISSED}' END, CASE WHEN busy THEN '{c.REASON_FREQUENT_SHORT}' END,
        CASE WHEN lonely THEN '{c.REASON_FEW_CALLBACKS}' END, CASE WHEN late THEN '{c.REASON_OUT_OF_HOURS}' END
      ) END AS rule_reasons,
      (CASE WHEN in_contact THEN -2 ELSE 0 END)
        + (CASE WHEN successful_call_count >= 5 AND avg_in_duration >= 60 THEN -1 ELSE 0 END) AS credit
    FROM (
      SELECT *, CASE {steps} ELSE {config.score_levels[-1][1]} END AS model_level,
        phone IN ({listed or quoted(config.blacklist)}) AS listed,
        {risky} AS risky, {hit} AS hit,
        total_call >= 2 AND avg_duration < 5 AS brief,
        CASE WHEN total_call >= 5 THEN miss_call / CAST(total_call AS DOUBLE) > 0.6 ELSE false END AS missed,
        frequency_per_day >= 10 AND avg_duration < 10 AS busy,
        callback_rate < 0.1 AND total_call >= 5 AS lonely, mostly_out_of_business_hour AS late
      FROM ({risk_features(pool or risk_pool())}) f
    ) s
    """


def risk_evaluate(listed: str | None = None, prefixes: str | None = None) -> str:
    c = constants
    titles = quoted(t for t, _ in c.LEVEL_MESSAGES.values())
    subtitles = quoted(s for _, s in c.LEVEL_MESSAGES.values())
    shown, level_text, end = c.REASON_SCORE.split("{}")
    rule_text, rule_end = c.REASON_RULE_LEVEL.split("{}")
    return f"""
    SELECT phone, final_level, model_level, rule_level, [{titles}][final_level + 1] AS title,
      [{subtitles}][final_level + 1] AS subtitle,
      concat_ws(' | ', '{shown}' || printf('%.2f', score) || '{level_text}' || model_level || '{end}',
        CASE WHEN rule_level > 0 THEN '{rule_text}' || rule_level || '{rule_end}' END,
        nullif(rule_reasons, ''), CASE WHEN credit < 0 THEN '{c.REASON_TRUSTED}' END) AS reasons,
      is_international, prefix, total_call, avg_duration
    FROM (
      SELECT *, greatest(CASE WHEN is_international THEN 1 ELSE 0 END,
        greatest(model_level, rule_level) + credit) AS final_level
      FROM ({risk_levels(listed, None, prefixes)}) l
    ) e
    """


def split(rows: str, key: str, keep: str) -> str:
    """Role by rank of the key's hash within its class; ``key`` is the expression that is hashed."""
    return f"""
    SELECT {keep}, CASE WHEN place < tested THEN 'test'
      WHEN place < tested + ceil((n - tested) * CAST(0.2 AS DOUBLE)) THEN 'validation' ELSE 'train' END AS role
    FROM (
      SELECT *, rank() OVER (PARTITION BY label ORDER BY md5(CAST({key} AS VARCHAR) || ':42')) - 1 AS place,
        count(*) OVER (PARTITION BY label) AS n,
        ceil(count(*) OVER (PARTITION BY label) * CAST(0.15 AS DOUBLE)) AS tested
      FROM ({rows}) s
    ) r
    """
