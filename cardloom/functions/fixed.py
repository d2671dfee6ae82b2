"""Word lists, patterns and formats that results depend on, in their natural order."""

from __future__ import annotations

# Patterns, in the syntax that Spark reads ((?U): \d and \s as in Unicode).
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"(?U)(?:\+?\d{1,4}[-\s]?)?(?:\(?\d{2,4}\)?[-\s]?)?\d{3,4}[-\s]?\d{4}(?:[-\s]?\d{1,4})?"
WEBSITE = r"(?U)(?:https?://|www\.)[A-Za-z0-9.\-]+\.[A-Za-z]{2,}(?:/[^\s]*)?"
WECHAT = r"(?U)(?:微信|wechat|WeChat|WX|vx)[:：\s]*([A-Za-z0-9_\-]{5,})"
QQ = r"(?U)(?:QQ|qq)[:：\s]*([1-9]\d{4,11})"
MOBILE = r"1[3-9][0-9]{9}"
SEPARATORS = r"(?U)[;,，/|、\s]+"
DIRTY = r"(?i)lyzd\d|\.com|http|www\.|@@@"

# Keywords of cards; the first 16 titles, 14 companies and 12 address words are those of pages.
TITLES = [
    "总监", "经理", "主管", "总经理", "董事长", "CEO", "COO", "CTO", "CFO", "VP", "销售", "商务", "工程师", "顾问", "主任", "创始人",
    "director", "manager", "president", "owner",
]
COMPANIES = ["公司", "集团", "有限公司", "研究院", "工作室", "事务所", "厂", "Inc", "INC", "Ltd", "LTD", "LLC", "Corporation", "Corp", "CO.,", "CO.,LTD"]
ADDRESSES = ["省", "市", "区", "县", "路", "街", "号", "大厦", "室", "楼", "园区", "镇", "ADD", "Address"]

# What makes a service's error final.
FATAL_STATUS = [401, 402, 403]
FATAL_WORDS = ["quota", "balance", "欠费", "余额", "鉴权", "unauthorized", "access denied", "permission", "invalid access", "ak/sk", "credential"]

# The partitions of the published run (folder, label) and its data set.
PARTITIONS = [
    ("ocr_run_20260508_PartA", "1期-PartA"), ("ocr_run_20260508_PartB", "1期-PartB"),
    ("ocr_run_20260508_PartC", "1期-PartC"), ("ocr_run_20260508_PartD", "1期-PartD"),
    ("ocr_run_20260527_P2PartA", "2期-PartA"), ("ocr_run_20260527_P2PartB", "2期-PartB"),
    ("ocr_run_20260527_P2PartC", "2期-PartC"), ("ocr_run_20260527_P2PartD", "2期-PartD"),
    ("ocr_run_20260527_P3PartA", "3期-PartA"), ("ocr_run_20260527_P3PartB", "3期-PartB"),
    ("ocr_run_20260527_P3PartC", "3期-PartC"), ("ocr_run_20260527_P3PartD", "3期-PartD"),
]
DATASET = "139届广交会"
TOTAL = "合计"

# Sheet names, notes and kinds in deliverables.
PHONE_SHEET, SUMMARY_SHEET, STATS_SHEET = "phone_processed", "汇总统计", "处理统计"
NOTE_DIFFERENT, NOTE_A, NOTE_B = "手机号集合不一致", "仅链路A有号", "仅链路B有号"
KIND_A, KIND_B = "仅链路A手机号", "仅链路B手机号"

# Short names of models in file names.
MODEL_SHORT = [("flash", "dsv4flash"), ("pro", "dsv4p")]

# Suffixes of inputs.
IMAGE_SUFFIXES = ["jpg", "jpeg", "png", "bmp", "pdf", "heic", "heif"]
