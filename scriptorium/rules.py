"""Fixed values of the corpus rules, stated as data, and the rule set that carries them."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, field
from pathlib import Path

# Boilerplate prefixes.
BOILERPLATE = ("姊妹计划", "Public domain", "本作品在全世界都属于", "本作品 原文没有標點")

# Han block used by the cleaning and location rules.
HAN = "\\x{3400}-\\x{9fff}"

# Brackets that keep a sentence open, and sentence ends.
BRACKETS = {"〈": "〉", "《": "》", "（": "）", "(": ")", "「": "」", "『": "』", "【": "】", "[": "]"}
SENTENCE_ENDS = "。！？!?｡"

# Numerals of volume headings and the parts of a volume.
NUMERALS = {"零": 0, "〇": 0, "一": 1, "二": 2, "兩": 2, "三": 3, "四": 4, "五": 5, "六": 6, "七": 7, "八": 8, "九": 9,
            "十": 10, "百": 100, "千": 1000, "万": 10000}
PARTS = {"上": "a", "中": "b", "下": "c", "a": "a", "b": "b", "c": "c"}

# Era names, and the patterns in order of precedence.
ERAS = ("建武", "永平", "建安", "元嘉", "太和", "孝昌", "武德", "貞觀", "開元", "天寶", "乾隆", "寶慶", "更始", "地皇", "天鳳", "永興",
        "正始", "太康", "咸和", "大業", "顯慶", "神龍", "天成", "同光", "廣順", "乾祐", "顯德")
OFFICES = ("太守", "刺史", "將軍", "大將軍", "司馬", "尚書", "侍郎", "丞相", "御史", "博士", "校尉", "中郎將", "令史", "大夫", "太子", "公主",
           "皇帝", "皇后", "侯國", "縣令")
PATTERNS = (
    ("BOOK", "《[^》\\n]{1,40}》"),
    ("TIME", f"(?:{'|'.join(ERAS)})?(?:元年|[一二三四五六七八九十百千万〇零０-９0-9]{{1,4}}年)"),
    ("OFFICIAL_TITLE", f"(?:{'|'.join(OFFICES)})"),
    ("POLITY", "(?:漢|魏|吳|蜀|秦|楚|齊|梁|陳|周|晉|隋|唐|宋|遼|金|元|明|清)(?:朝|國|氏)"),
    ("LOCATION", f"[{HAN}]{{1,6}}(?:郡|縣|州|邑|城|關|鄉|鎮)"),
)

# Built-in gazetteer.
SEED_LOCATIONS = ("長安", "洛陽", "沛", "南陽郡", "成都", "建康", "汴京", "臨安", "大都", "滄州")
SEED_POLITIES = ("魏", "吳", "蜀", "楚", "齊", "梁", "陳")
SEED_DYNASTIES = ("漢", "秦", "周", "晉", "隋", "唐", "宋", "遼", "金", "元", "明", "清")

# Cues around one-character dynasties, short names and persons.
DYNASTY_AFTER, DYNASTY_BEFORE = "朝亡初末中代國時", "入伐據都建興亡。！？\n"
NAME_BEFORE, NAME_AFTER, NAME_MARKS = "帝王公侯君后妃氏姓名召拜遣命殺見謂將", "曰傳字卒死者", "，。、；："
TITLE_BEFORE = ("將軍", "太守", "刺史", "丞相", "尚書", "侍郎", "校尉", "縣令")
VERB_AFTER = "為序討帥奔降薨卒曰"

# Weights of sources.
PRIORITY = {"regex": 0.55, "seed": 0.70, "gazetteer": 0.70, "kb": 0.85, "kb_full": 0.85, "model_basic": 0.65, "guwen_basic": 0.65,
            "model_crf": 0.75, "guwen_crf": 0.75, "human": 1.0}
UNKNOWN_PRIORITY = 0.5

# Filters of person names.
PLACEHOLDERS = ("不詳", "佚名", "失名", "未詳", "某人", "某某", "無名", "無名氏", "闕名")
NAME_NUMERALS = "零〇一二三四五六七八九十百千萬万億亿兩两"
TITLE_SUFFIXES = ("夫人", "先生", "國師", "国师", "可汗", "皇帝", "皇后")
PERSONAL_ALIAS_TYPES = (3, 4, 5, 9, 10, 13, 17, 19, 20, 21)
NAME_HAN = "\\x{3400}-\\x{4DBF}\\x{4E00}-\\x{9FFF}\\x{F900}-\\x{FAFF}\\x{20000}-\\x{2FA1F}\\x{30000}-\\x{323AF}"

# Dynasty codes that fit a period.
PERIOD_CODES = {
    "西漢": (2, 29, 83), "東漢": (2, 25, 83),
    "南北朝": (4, 23, 24, 27, 28, 30, 31, 32, 35, 37, 39, 40, 41, 44, 50, 51, 56, 60, 62, 63, 64, 65, 68, 69, 70, 71, 72, 73, 74, 76, 82, 87),
    "五代": (7, 8, 9, 10, 11, 12, 13, 34, 36, 38, 47, 48, 49, 52, 55, 66, 75), "唐": (6, 77), "宋": (15,),
}

# Works, by file name.
WORKS = (
    ("北史_full.txt", "北史", "Bắc Sử", "南北朝", "正史", "HCH_003"),
    ("北齊書_full.txt", "北齊書", "Bắc Tề Thư", "南北朝", "正史", "HCH_004"),
    ("Chư Phiên Chí - 諸蕃志_full.txt", "諸蕃志", "Chư Phiên Chí", "宋", "地理志", "HCH_001"),
    ("舊唐書_full.txt", "舊唐書", "Cựu Đường Thư", "唐", "正史", "HCH_008"),
    ("舊五代史_full.txt", "舊五代史", "Cựu Ngũ Đại Sử", "五代", "正史", "HCH_007"),
    ("Đông Quan Hán Ký - 東觀漢記_(四庫全書本)_full.txt", "東觀漢記_(四庫全書本)", "Đông Quán Hán Ký", "東漢", "史書", "HCH_002"),
    ("漢書_full.txt", "漢書", "Hán Thư", "西漢", "正史", "HCH_006"),
    ("後漢書_full.txt", "後漢書", "Hậu Hán Thư", "東漢", "正史", "HCH_005"),
)

# Headers of place tables (id, name, begin, end, type, parent).
PLACE_HEADERS = (
    ("PLACE_ID", "NAME_CN", "BEGIN", "END", "TYPE", "PARENT_ID"),
    ("id", "name", "begin", "end", "type", "parent"),
    ("CHGIS_ID", "PLACE_NAME", "START_YEAR", "END_YEAR", "ADMIN_TYPE", "PARENT_CHGIS_ID"),
)

INTERNAL_LABELS = ("PERSON", "LOCATION", "POLITY", "DYNASTY", "OFFICIAL_TITLE", "BOOK", "TIME", "NUMBER")
SUBMISSION_LABELS = ("PER", "LOC", "ORG", "TITLE", "TME", "NUM")
CRITICAL_SOURCES = ("cbdb", "guwen_basic")


class MappingError(ValueError):
    """A label mapping that breaks its rules."""


@dataclass(frozen=True)
class LabelMapping:
    """Internal labels to delivered labels, groups that may merge, and which label of a group wins."""

    version: str = "0.2.0"
    confirmed: bool = False
    to_submission: dict[str, str] = field(default_factory=lambda: {
        "PERSON": "PER", "LOCATION": "LOC", "POLITY": "ORG", "DYNASTY": "ORG", "OFFICIAL_TITLE": "TITLE", "BOOK": "TITLE",
        "TIME": "TME", "NUMBER": "NUM"})
    compatible: dict[str, tuple[str, ...]] = field(default_factory=lambda: {"DYNASTY": ("POLITY",), "BOOK": ("OFFICIAL_TITLE",)})
    rank: dict[str, int] = field(default_factory=lambda: {"DYNASTY": 0, "POLITY": 1, "BOOK": 0, "OFFICIAL_TITLE": 1})
    conflict_policy: str = "exclude"

    def __post_init__(self):
        checks = (
            (isinstance(self.version, str) and self.version, "version must be a non-empty string"),
            (isinstance(self.confirmed, bool), "confirmed must be true or false"),
            (isinstance(self.to_submission, dict) and self.to_submission, "mapping must be a table"),
            (set(self.to_submission or ()) <= set(INTERNAL_LABELS), "mapping has an unknown internal label"),
            (set(INTERNAL_LABELS) <= set(self.to_submission or ()), "mapping lacks an internal label"),
            (set((self.to_submission or {}).values()) <= set(SUBMISSION_LABELS), "mapping has an unknown delivered label"),
            (self.conflict_policy in ("exclude", "include_first", "include_all"), "unknown conflict policy"),
            (isinstance(self.compatible, dict) and all(isinstance(v, (list, tuple)) for v in self.compatible.values()), "groups must be lists"),
            (set(self.compatible or ()) | {x for v in (self.compatible or {}).values() for x in v} <= set(INTERNAL_LABELS), "a group has an unknown label"),
            (isinstance(self.rank, dict) and all(isinstance(v, int) and not isinstance(v, bool) for v in self.rank.values()), "ranks must be integers"),
            (set(self.rank or ()) <= set(INTERNAL_LABELS), "a rank has an unknown label"),
        )
        for ok, message in checks:
            if not ok:
                raise MappingError(message)

    def fits(self, a: str, b: str) -> bool:
        return a == b or b in self.compatible.get(a, ()) or a in self.compatible.get(b, ())

    def preferred(self, a: str, b: str) -> str:
        return b if self.rank.get(b, 99) < self.rank.get(a, 99) else a


_LOADED: dict[str, tuple[float, LabelMapping]] = {}


def load_mapping(path: str | Path) -> LabelMapping:
    """Read a mapping from TOML; kept until the file changes."""
    p = Path(path)
    if not p.exists():
        raise MappingError(f"no mapping at {p}")
    changed = p.stat().st_mtime
    if _LOADED.get(str(p), (None,))[0] == changed:
        return _LOADED[str(p)][1]
    try:
        raw = tomllib.loads(p.read_text("utf-8"))
    except tomllib.TOMLDecodeError as e:
        raise MappingError(f"not TOML: {e}") from e
    groups = raw.get("label_groups", {})
    got = LabelMapping(
        raw.get("version", ""), raw.get("confirmed"), raw.get("mapping"), groups.get("compatible", {}),
        groups.get("priority_label_order", {}), raw.get("policy", {}).get("unresolved_conflict", "exclude"))
    _LOADED[str(p)] = (changed, got)
    return got


def forget_mappings() -> None:
    _LOADED.clear()


def seeds() -> list[tuple[str, str]]:
    """(term, label) of the built-in gazetteer."""
    return ([(t, "LOCATION") for t in SEED_LOCATIONS] + [(t, "POLITY") for t in SEED_POLITIES]
            + [(t, "DYNASTY") for t in SEED_DYNASTIES] + [(t, "OFFICIAL_TITLE") for t in OFFICES])
