"""Personal data: base patterns, and boosted trees over further candidates.

Everything is Catalyst expressions over one row at a time, so neither a text
nor a span is ever shuffled. ``split`` and ``regexp_extract_all`` by the same
pattern give the gaps and the matches in turn; their running lengths are the
spans. The trees are learned by MLlib from all candidates, counted by what
their features say, and then written out as CASE expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlens.session import stored

KINDS = ("email", "ip", "card", "phone")
#: Spans that the trees add, by the generator that proposed them.
ADDED_KINDS = ("address", "number")
LEAST_PRECISION = 0.99
#: A kind is added only if so many held-out candidates were right from its threshold on.
LEAST_HELD_OUT = 20
TREES = 12
DEPTH = 4

# Matches never shrink after the fact, so possessive loops find what greedy
# ones do, and neither recurse nor run back over long texts. A match can only
# begin where a run of its first characters begins or the last match ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?s)[0-9](?<![0-9].)[0-9]*+(?:\.[0-9]++){3}",
    "card": r"(?s)[0-9](?<![0-9].)(?<![0-9][\x20-].)(?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "address": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+",
    "number": r"(?s)[+(]{0,2}[0-9](?<![0-9].)(?:[\x20().-]{0,3}[0-9]){6,}+",
    "run": r"(?s)[0-9](?<![0-9].)[0-9]{6,}+",
}
#: What a text must contain for a pattern to be tried.
HINTS = {
    "email": "contains({t}, '@')",
    "phone": "contains({t}, '+')",
    "address": "contains({t}, '@') or contains({t}, '(at)') or contains({t}, '[at]')",
}
DIGITS_HINT = r"(?s)[0-9].{0,3}[0-9]"
FEATURES = (
    "digits", "characters", "dots", "spaces", "hyphens", "parentheses", "luhn", "octets", "labels", "top",
    "letter_before", "letter_after", "digit_before", "digit_after", "called", "grouped", "rung", "coded",
)
#: Other forms made of base spans for learning, (what is replaced, by what): right ones and wrong ones, such as a host without
#: a top-level name or a number after "order". Both come short and long, with digits and without, so that neither gives them away.
REWRITTEN = (
    (
        r"(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]++)@([A-Za-z0-9-]++)((?:\.[A-Za-z0-9-]++(?=\.[A-Za-z0-9-]))*+)(\.[A-Za-z0-9-]++)",
        (
            "$1 (at) $2$3$4", "$1 [at] $2$4", "contact(at)$2$3$4", "x [at] y$4",
            "$1 (at) $2", "contact [at] $2", "$1$1 (at) $2-$2-$2", "x (at) y",
        ),
    ),
    (
        r"\+[0-9]{1,3}[\x20.-]?\(([0-9]{3})\)[\x20]?([0-9]{3})-(?=[0-9]{4})",
        ("($1) $2-", "tel ($1) $2-", "call $1-$2-", "phone: $1.$2-", "$1-$2-", "order ($1) $2-", "code $1-$2-", "ref $1.$2-"),
    ),
    (r"\+[0-9]{1,3}[\x20.-]?(?=\()", ("", "tel ", "call ", "phone: ", "", "order ", "code ", "ref ")),
    (
        r"(?<![0-9])([0-9]{4})[\x20-]([0-9]{4})[\x20-]([0-9]{4})[\x20-]([0-9]{4})(?![0-9])",
        (*("$1.$2.$3.$4",) * 4, "card $1.$2.$3.$4", "of $1.$2.$3.$4", "order $1.$2.$3.$4", "id $1.$2.$3.$4"),
    ),
)
#: What a candidate, its separators aside, must show to count as personal data beside the base spans.
LIKELY = (
    "(c.kind = 'address' AND c.f.labels >= 2 AND c.f.top = 1) OR (c.kind = 'number' AND c.f.letter_before = 0 "
    "AND c.f.letter_after = 0 AND c.f.coded = 0 AND ((c.f.luhn = 1 AND c.f.digits >= 16) OR c.f.grouped = 1 "
    "OR (c.f.rung = 1 AND c.f.octets = 0 AND c.f.digits BETWEEN 7 AND 15)))"
)
AT = r"@|\(at\)|\[at\]"
#: Three, three and four digits, told apart by more than spaces, with or without a country code.
GROUPED = r"^(?:[+]?[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{3}\)[\x20.-]{0,2}|[0-9]{3}[.-])[0-9]{3}[\x20.-][0-9]{4}$"
RUNG = r"(?:^|[^a-z])(?:tel|telephone|phone|fax|mobile|cell|call)(?: (?:number|no|me|us|at|on))*[^a-z0-9]{0,3}$"
CODED = r"(?:^|[^a-z])(?:order|code|invoice|ref|reference|item|sku|serial|isbn|id|part|ticket|tracking)(?: (?:number|no|code|id))?[^a-z0-9]{0,3}$"
SPAN = "struct<kind:string,start:bigint,stop:bigint>"


def literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def running(array: str) -> str:
    """SQL: the sum of the elements before each one; blocks keep the copying linear in practice."""
    sums = "aggregate({a}, array(0L), (sums, x) -> array_append(sums, element_at(sums, -1) + x))"
    blocks = (
        f"transform(sequence(0, greatest(size({array}) - 1, 0), 512), "
        f"i -> {sums.format(a=f'slice({array}, i + 1, 512)')})"
    )
    return (
        f"transform(array({blocks}), bs -> flatten(zip_with(bs, "
        f"slice({sums.format(a='transform(bs, b -> element_at(b, -1))')}, 1, size(bs)), "
        f"(b, past) -> transform(slice(b, 1, size(b) - 1), x -> x + past))))[0]"
    )


def located(text: DataFrame, column: str, name: str) -> DataFrame:
    """Adds ``<name>_at``: every match of a pattern with its span and the text around it."""
    pattern = literal(PATTERNS[name])
    hint = HINTS.get(name, "digits_near").format(t=column)
    gaps, hits, lengths, starts = (f"{name}_{part}" for part in ("gaps", "hits", "lengths", "starts"))
    split = text.withColumn(hits, F.expr(f"CASE WHEN {hint} THEN regexp_extract_all({column}, {pattern}, 0) ELSE array() END"))
    split = split.withColumn(gaps, F.expr(f"CASE WHEN size({hits}) > 0 THEN split({column}, {pattern}, -1) END"))
    # Gap and match in turn: two lengths per match.
    split = split.withColumn(
        lengths, F.expr(f"flatten(transform({hits}, (h, i) -> array(bigint(length({gaps}[i])), bigint(length(h)))))")
    )
    split = split.withColumn(starts, F.expr(f"CASE WHEN size({hits}) > 0 THEN {running(lengths)} END"))
    return split.withColumn(
        f"{name}_at",
        F.expr(
            f"transform({hits}, (h, i) -> struct(h AS found, {starts}[2 * i + 1] AS start, "
            f"{starts}[2 * i + 1] + length(h) AS stop, "
            f"right({gaps}[i], 24) AS before, left({gaps}[i + 1], 1) AS after))"
        ),
    ).drop(gaps, hits, lengths, starts)


def digits_of(found: str) -> str:
    return f"regexp_replace({found}, '[^0-9]', '')"


def luhn(digits: str) -> str:
    """SQL: whether at most 19 digits pass the check; zeros in front do not matter."""
    padded = f"lpad({digits}, 19, '0')"
    doubled = f"translate({padded}, '0123456789', '0246813579')"
    terms = [f"int(substring({padded if i % 2 else doubled}, {i}, 1))" for i in range(1, 20)]
    return f"(({' + '.join(terms)}) % 10 = 0)"


ACCEPTED = {
    "email": "true",
    "ip": r"forall(split(x.found, '[.]'), p -> length(ltrim('0', p)) <= 3 AND int(right(concat('000', p), 3)) <= 255)",
    "card": luhn(digits_of("x.found")),
    "phone": f"length({digits_of('x.found')}) BETWEEN 8 AND 15",
}


def with_base_spans(docs: DataFrame, text: str) -> DataFrame:
    """Adds ``base``: the accepted matches of the base patterns by kind and start."""
    out = docs.withColumn("digits_near", F.expr(f"{text} RLIKE {literal(DIGITS_HINT)}"))
    for kind in KINDS:
        out = located(out, text, kind)
    parts = [
        f"transform(filter({kind}_at, x -> {ACCEPTED[kind]}), "
        f"x -> struct('{kind}' AS kind, x.start AS start, x.stop AS stop))"
        for kind in KINDS
    ]
    return out.withColumn("base", F.expr(f"concat({', '.join(parts)})")).drop(*[f"{kind}_at" for kind in KINDS])


def described(candidate: str) -> str:
    """SQL: format and context features of one candidate, all DOUBLE."""
    found, digits = f"{candidate}.found", digits_of(f"{candidate}.found")

    def number(of: str) -> str:
        return f"double(length({found}) - length(translate({found}, '{of}', '')))"

    def flag(condition: str) -> str:
        return f"double(int(coalesce({condition}, false)))"

    values = {
        "digits": f"double(length({digits}))",
        "characters": f"double(length({found}))",
        # Dots of an address are told by its labels.
        "dots": f"CASE WHEN {found} RLIKE {literal(AT)} THEN 0D ELSE {number('.')} END",
        "spaces": number(" "),
        "hyphens": number("-"),
        "parentheses": number("()"),
        "luhn": flag(f"length({digits}) BETWEEN 12 AND 19 AND {luhn(digits)}"),
        "octets": flag(
            f"{found} RLIKE '^[0-9.]+$' AND size(split({found}, '[.]')) = 4 AND "
            f"forall(split({found}, '[.]'), p -> length(p) <= 3 AND int(right(concat('000', p), 3)) <= 255)"
        ),
        "labels": f"CASE WHEN {found} RLIKE {literal(AT)} THEN double(size(split({found}, {literal(AT + '|[.]')})) "
        f"- size(split(split({found}, {literal(AT)})[0], '[.]'))) ELSE 0D END",
        "top": flag(f"{found} RLIKE '[.][A-Za-z]{{2,}}$'"),
        "letter_before": flag(f"right({candidate}.before, 1) RLIKE '[A-Za-z]'"),
        "letter_after": flag(f"{candidate}.after RLIKE '[A-Za-z]'"),
        "digit_before": flag(f"{candidate}.before RLIKE '[0-9][^A-Za-z0-9]?$'"),
        "digit_after": flag(f"{candidate}.after RLIKE '[0-9]'"),
        "called": flag(f"lower({candidate}.before) RLIKE '(tel|phone|call|fax|mobil|card|visa|mail|contact|addr)'"),
        "grouped": flag(f"{found} RLIKE {literal(GROUPED)}"),
        "rung": flag(f"lower({candidate}.before) RLIKE {literal(RUNG)}"),
        "coded": flag(f"lower({candidate}.before) RLIKE {literal(CODED)}"),
    }
    return "named_struct(" + ", ".join(f"'{name}', {values[name]}" for name in FEATURES) + ")"


PROPOSAL = "struct('{kind}' AS kind, x.start AS start, x.stop AS stop, x.found AS found, x.before AS before, x.after AS after)"


def with_proposals(docs: DataFrame, text: str) -> DataFrame:
    """Adds ``proposed``: what the wide generators find, which overlap each other and the base spans."""
    out = docs
    for name in ("address", "number", "run"):
        out = located(out, text, name)
    tagged = [
        f"transform({name}_at, x -> {PROPOSAL.format(kind=kind)})"
        for name, kind in (("address", "address"), ("number", "number"), ("run", "number"))
    ]
    out = out.withColumn("proposed", F.expr(f"array_distinct(concat({', '.join(tagged)}))"))
    return out.drop("address_at", "number_at", "run_at")


def with_candidates(docs: DataFrame, text: str) -> DataFrame:
    """Adds ``candidates``: the proposals with their features."""
    return with_proposals(docs, text).withColumn(
        "candidates",
        F.expr(f"transform(proposed, c -> struct(c.kind AS kind, c.start AS start, c.stop AS stop, {described('c')} AS f))"),
    ).drop("proposed")


@dataclass(frozen=True)
class SpanModel:
    """Trees as SQL over a candidate ``c``, and the least score per added kind (None: nothing is added)."""

    score: str
    thresholds: dict[str, float | None]


NO_MODEL = SpanModel("0D", dict.fromkeys(ADDED_KINDS))


def tree_sql(node) -> str:
    """One tree of MLlib as nested CASE expressions over the features of ``c``."""
    if node.getClass().getSimpleName() == "LeafNode":
        return f"{node.prediction()!r}D"
    split = node.split()
    return (
        f"CASE WHEN c.f.{FEATURES[split.featureIndex()]} <= {split.threshold()!r}D "
        f"THEN {tree_sql(node.leftChild())} ELSE {tree_sql(node.rightChild())} END"
    )


def rewritten(docs: DataFrame, text: str) -> DataFrame:
    """Texts with base spans in the forms that the base patterns leave out; texts without such spans go."""
    out = docs.where(f"contains({text}, '@') OR contains({text}, '+') OR {text} RLIKE '[0-9]{{4}}[ -][0-9]{{4}}[ -][0-9]{{4}}'")
    draw = f"pmod(xxhash64({text}), {len(REWRITTEN[0][1])})"
    changed = text
    for pattern, forms in REWRITTEN:
        choices = f"array({', '.join(literal(form) for form in forms)})"
        changed = f"regexp_replace({changed}, {literal(pattern)}, element_at({choices}, int(draw) + 1))"
    return out.withColumn("draw", F.expr(draw)).select(F.expr(changed).alias("changed"), F.col(text).alias("old")).where(
        "changed <> old"
    ).select(F.col("changed").alias(text))


def train(docs: DataFrame, text_column: str = "text") -> SpanModel:
    """Learns which candidates look like personal data, and how high a score must be to be trusted.

    A candidate counts as right if it is a base span or is ``LIKELY`` one in
    another form: (at) for @, no plus, other separators, a telling word before
    it. Texts that hold base spans are learned from a second time with these
    in such forms, so that they are known where a table has none. The features
    do not tell the @ and the plus. Each kind has trees of its own, lest the
    length of a number decide about an address. Of all candidates (those of equal
    texts count once), three quarters train the trees and the rest calibrate the
    thresholds: the lowest score above which ``LEAST_PRECISION`` of the candidates
    are right, and at least ``LEAST_HELD_OUT`` of them. Candidates with equal
    features and labels are one row with their number as its weight, so what MLlib
    reads grows with the forms in use and not with the table. A kind with fewer
    held-out candidates, as in a small table, is never added; base spans do not
    depend on it.
    """
    texts = docs.select(F.col(f"`{text_column}`").alias("text"))
    found = with_proposals(with_base_spans(texts.unionByName(rewritten(texts, "text")), "text"), "text")
    # No filter on the arrays: it would be pushed to the scan with a copy of the whole search for each mention of them.
    rows = (
        found.select(F.xxhash64("text").alias("hash"), "base", F.explode_outer("proposed").alias("p"))
        .where("p is not null")
        .select(
            F.xxhash64("hash", "p.start", "p.stop").alias("hash"),
            "p",
            F.expr("exists(base, b -> b.start = p.start AND b.stop = p.stop)").alias("is_base"),
        )
        .dropDuplicates(["hash"])
    )
    labelled = stored(rows, "proposals").select(
        F.expr("pmod(hash, 4) = 0").alias("held_out"), "is_base", F.expr(f"struct(p.kind AS kind, {described('p')} AS f)").alias("c")
    ).select("held_out", "c", F.expr(f"double(int(is_base OR {LIKELY}))").alias("label"))
    counted = stored(labelled.groupBy("held_out", "c", "label").agg(F.count("*").cast("double").alias("n")), "candidates")
    scores = {kind: boosted(counted.where(F.col("c.kind") == kind).where("NOT held_out")) for kind in ADDED_KINDS}
    if not any(scores.values()):
        return NO_MODEL
    score = "CASE " + " ".join(f"WHEN c.kind = '{kind}' THEN {sql}" for kind, sql in scores.items() if sql) + " ELSE 0D END"
    scored = counted.where("held_out").select(
        F.col("c.kind").alias("kind"), F.expr(f"floor(({score}) * 100)").alias("bin"), "label", "n"
    )
    bins = scored.groupBy("kind", "bin").agg(F.expr("sum(label * n)").alias("good"), F.sum("n").alias("n")).collect()
    return SpanModel(score, {kind: trusted([b for b in bins if b.kind == kind]) for kind in ADDED_KINDS})


def boosted(learning: DataFrame) -> str | None:
    """Boosted trees over the candidates ``c`` of one kind, ``n`` times each, as SQL for the probability of being right.

    None without both labels.
    """
    if len(learning.select("label").distinct().take(2)) < 2:
        return None
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(
        learning.select("label", "n", "c.f.*")
    )
    trees = GBTClassifier(
        featuresCol="features", labelCol="label", weightCol="n", maxIter=TREES, maxDepth=DEPTH, seed=7, maxBins=64, checkpointInterval=-1
    ).fit(vectors.select("features", "label", "n"))
    weighted = [
        f"{weight!r}D * ({tree_sql(tree._java_obj.rootNode())})"
        for weight, tree in zip(trees.treeWeights, trees.trees, strict=True)
    ]
    return f"1D / (1D + exp(-2D * ({' + '.join(weighted)})))"


def trusted(bins: list, least_held_out: int = LEAST_HELD_OUT) -> float | None:
    """The lowest score, in hundredths, from which on enough of the candidates were right; None if too few were seen."""
    good = seen = 0
    least = None
    for row in sorted(bins, key=lambda b: -b.bin):
        good, seen = good + row.good, seen + row.n
        if good >= least_held_out and good / seen >= LEAST_PRECISION:
            least = row.bin / 100
    return least


def with_spans(docs: DataFrame, text: str, model: SpanModel) -> DataFrame:
    """Adds ``base`` and ``added``: trusted candidates that overlap no base span."""
    out = with_candidates(with_base_spans(docs, text), text)
    trusted_kinds = {kind: least for kind, least in model.thresholds.items() if least is not None}
    if not trusted_kinds:
        return out.withColumn("added", F.array().cast(f"array<{SPAN}>")).drop("candidates", "digits_near")
    # The score is mentioned once, as the driver parses, plans and compiles its trees for each mention.
    limits = " ".join(f"WHEN '{kind}' THEN {least!r}D" for kind, least in trusted_kinds.items())
    wanted = f"{model.score} >= CASE c.kind {limits} END"
    added = (
        f"array_sort(transform(filter(candidates, c -> NOT exists(base, b -> b.start < c.stop AND c.start < b.stop) "
        f"AND ({wanted})), c -> struct(c.kind AS kind, c.start AS start, c.stop AS stop)))"
    )
    return out.withColumn("added", F.expr(added)).drop("candidates", "digits_near")


def listed(spans: str) -> str:
    return f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.stop)), ',')"


def find_personal_data(
    docs: DataFrame, model: SpanModel, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: numbers of base spans by kind, their digest, and all spans.

    Spans are ``kind:start:end`` in code points, the end exclusive, by kind and
    start. A null text counts as empty and has none. Repeated rows and null
    ids give rows like others; other columns are not read.
    """
    plain = docs.select(F.col(f"`{id_column}`").alias("id"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"))
    found = with_spans(plain, "text", model)
    counts = [F.expr(f"bigint(size(filter(base, s -> s.kind = '{kind}')))").alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        F.col("id").alias(id_column),
        *counts,
        F.sha2(F.expr(listed("base")), 256).alias("base_sha256"),
        F.expr(listed("concat(base, added)")).alias("spans"),
    )


def redact(docs: DataFrame, model: SpanModel, text_column: str = "text", length_column: str = "n_chars") -> DataFrame:
    """The documents, with all their columns, and every span replaced by its kind in brackets.

    Overlapping spans become one, named after the first. A column that holds
    the length of the text follows it. A null text stays null.
    """
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    found = with_spans(docs.select(row, F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text")), "text", model)
    rewritten = (
        "aggregate(array_sort(transform(concat(base, added), s -> struct(s.start AS start, s.stop AS stop, s.kind AS kind))), "
        "named_struct('done', 0L, 'out', ''), "
        "(a, s) -> CASE WHEN s.start < a.done THEN named_struct('done', greatest(a.done, s.stop), 'out', a.out) "
        "ELSE named_struct('done', s.stop, 'out', concat(a.out, substring(text, int(a.done) + 1, int(s.start - a.done)), '[', s.kind, ']')) END, "
        "a -> concat(a.out, substring(text, int(a.done) + 1, length(text))))"
    )
    found = found.withColumn("new", F.expr(f"CASE WHEN size(base) + size(added) = 0 THEN text ELSE {rewritten} END"))
    kept = F.when(F.col(f"row.`{text_column}`").isNotNull(), F.col("new"))

    def column(name: str):
        if name == text_column:
            return kept.alias(name)
        old = F.col(f"row.`{name}`")
        if name == length_column:
            return F.when(kept.isNotNull(), F.length(kept)).otherwise(old).cast(docs.schema[name].dataType).alias(name)
        return old.alias(name)

    return found.select(*[column(name) for name in docs.columns])
