"""Tables and texts that results depend on."""

from __future__ import annotations

# Two digits after the 0 of a Vietnamese mobile number.
MOBILE_CODES = [
    "32", "33", "34", "35", "36", "37", "38", "39", "56", "58", "59", "70", "76", "77", "78", "79",
    "81", "82", "83", "84", "85", "86", "87", "88", "89", "90", "91", "92", "93", "94", "96", "97",
    "98", "99",
]

# Area codes after the 0 of a Vietnamese landline number.
LANDLINE_AREAS = [
    "24", "28",
    "203", "204", "205", "206", "207", "208", "209", "210", "211", "212", "213", "214", "215", "216",
    "218", "219", "220", "221", "222", "225", "226", "227", "228", "229", "232", "233", "234", "235",
    "236", "237", "238", "239", "251", "252", "254", "255", "256", "257", "258", "259", "260", "261",
    "262", "263", "269", "270", "271", "272", "273", "274", "275", "276", "277", "290", "291", "292",
    "293", "294", "296", "297", "299",
]

# Country calling codes that are recognised.
COUNTRY_CODES = [
    "1", "7",
    "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47",
    "48", "49", "51", "52", "53", "54", "55", "56", "57", "58", "60", "61", "62", "63", "64", "65",
    "66", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98",
    "212", "213", "216", "218", "351", "352", "353", "354", "355", "356", "357", "358", "359", "380",
    "381", "382", "385", "386", "387", "389",
]

# Network operators and the prefixes they own.
# Fixed value: working days that the shipped jobs count, Monday being 0.
SHIPPED_WORK_DAYS = (2, 3, 4, 5, 6)

PROVIDERS = {
    "gmobile": ["59", "99"],
    "itelecom": ["87"],
    "mobi": ["70", "76", "77", "78", "79", "89", "90", "93"],
    "vietel": ["32", "33", "34", "35", "36", "37", "38", "39", "86", "96", "97", "98"],
    "vina": ["81", "82", "83", "84", "85", "88", "91", "94"],
    "vnmobile": ["56", "58", "92"],
}

# The model's input columns, in training order.
FEATURE_COLUMNS = [
    "avg_in_contact", "same_network", "duration", "duration_call_to", "duration_call_in", "in_hour",
    "not_in_hour", "avg_success", "call_to", "call_in", "call_to_miss", "call_in_miss", "frequency",
    "total_frequency_to", "total_frequency_in", "total_frequency_to_by_phonemember",
    "total_frequency_in_by_phonemember", "time_join", "total_redial", "total_contacted",
    "total_contacted_to", "total_contacted_in", "mean_call_by_day", "call_to_rate", "call_in_rate",
    "call_to_miss_rate", "call_in_miss_rate", "callto_callin", "call_back_rate", "call_miss", "sum_call",
    "avg_duration_call_to", "avg_duration_call_in", "call_to_miss_mul_frequency", "duration_call_to_rate",
    "call_to_mul_in_contact", "call_to_mul_success", "frequency_mul_in_hour",
    "call_to_miss_frequency_in_hour", "call_in_div_call_to", "call_in_div_call_to_mul_in_hour",
    "call_to_miss_rate_mul_duration_call_to", "frequency_in_hour_mul_duration_call_to",
    "in_hour_mul_avg_success", "call_in_div_call_to_mul_in_hour_mul_avg_success",
]

# Score limits of the risk levels; a score below the limit gets the level.
SCORE_LEVELS = [(0.30, 0), (0.50, 1), (0.70, 2), (0.85, 3), (1.01, 4)]

# Foreign and domestic prefixes with many fraud warnings.
RISKY_FOREIGN_PREFIXES = ["224", "231", "232", "247", "252", "255", "370", "371", "375", "381", "563"]
RISKY_DOMESTIC_PREFIXES = ["1900", "022", "024", "026", "028"]

# Numbers published in fraud warnings.
BLACKLISTED_PHONES = [
    "+22375260052", "+22379262886", "+22382271520", "+4422222202", "+8919008198",
    "02439446395", "02444508888", "0245678520", "0249992623", "0249994266", "02499950036", "02499950060",
    "02499950212", "02499950412", "02499954266", "0249997035", "0249997037", "0249997038", "0249997041",
    "0249997044", "02499985212", "02499985220", "02499997044",
    "02822000266", "02856786501", "0287108690", "02871099082", "02873034653", "02873065555",
    "02899950012", "02899950015", "02899958588", "02899964437", "02899964438", "02899964439",
    "02899964448", "02899996142",
    "19001095", "19001199", "19002170", "19002190", "19002191", "19002196", "19002446", "19003439",
    "19003440", "19003441", "19004510", "19004562",
]

# Title and subtitle shown for each final level.
LEVEL_MESSAGES = {
    0: ("✅ Có vẻ an toàn", "Không phát hiện dấu hiệu bất thường."),
    1: ("⚠️ Cần chú ý một chút", "Có một vài dấu hiệu lạ, nhưng chưa đủ để xác định là spam."),
    2: ("⚠️ Có dấu hiệu nghi vấn", "Hệ thống phát hiện nhiều dấu hiệu giống cuộc gọi spam."),
    3: (
        "🚫 Nguy cơ cao – Có thể là cuộc gọi lừa đảo",
        "Số điện thoại này có nhiều đặc điểm trùng với các cuộc gọi spam đã được ghi nhận.",
    ),
    4: (
        "🛑 Rất có thể là cuộc gọi lừa đảo",
        "Số này trùng với mẫu hành vi spam/lừa đảo đã được hệ thống ghi nhận trước đó.",
    ),
}
UNKNOWN_MESSAGE = ("Không xác định", "")

# Sentences that explain a risk level; {} takes the value at hand.
REASON_BLACKLISTED = "Số này thuộc danh sách cảnh báo lừa đảo được công bố."
REASON_FOREIGN_RISKY = "Đầu số quốc tế {} có nhiều cảnh báo lừa đảo."
REASON_FOREIGN = "Cuộc gọi từ số quốc tế, cần cảnh giác."
REASON_PREFIX_SHORT_CALLS = "Đầu số {} với nhiều cuộc gọi rất ngắn giống hành vi nháy máy."
REASON_PREFIX = "Đầu số {} thường xuất hiện trong các cuộc gọi nghi vấn."
REASON_MISSED = "Tỷ lệ cuộc gọi nhỡ rất cao, bất thường so với các số thông thường."
REASON_FREQUENT_SHORT = "Gọi rất nhiều lần/ngày nhưng thời lượng ngắn, giống pattern spam."
REASON_FEW_CALLBACKS = "Rất ít người gọi lại số này, cho thấy mức độ tin cậy thấp."
REASON_OUT_OF_HOURS = "Cuộc gọi chủ yếu diễn ra ngoài giờ hành chính, cần cảnh giác."
REASON_SCORE = "Điểm rủi ro từ mô hình: {} (Level {})."
REASON_RULE_LEVEL = "Level từ rule: {}."
REASON_TRUSTED = "Đã giảm mức cảnh báo do số này thuộc danh bạ/lịch sử liên lạc tốt."

# Feedback rules and the notes they leave; {} takes a threshold.
NOTE_SPAM_STRONG = "total>={}, Uspam>={}, Rspam>={}, SR>={}"
NOTE_SPAM_VOLUME = "Rspam>={} (p95), Uspam>=2, SR>=0.60"
NOTE_HAM_STRONG = "total>={}, Uham>={}, Rham>={}, HR>={}, spam<=1"
NOTE_HAM_VOLUME = "Rham>={} (p95), Uham>=2, HR>=0.60, spam=0"
