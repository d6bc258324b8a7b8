"""Columns that parse, normalize and format published texts; what can't be parsed is null."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def stripped(text: Column) -> Column:
    """Without white space, of any kind, at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def parse_seconds(text: Column) -> Column:
    """``[H:]MM:SS`` in seconds; white space around it doesn't matter."""
    hit = r"^(?:([0-9]+):)?([0-9]{1,2}):([0-9]{2})$"
    bare = stripped(text)
    part = lambda i: F.regexp_extract(bare, hit, i)
    hours = F.when(part(1) == "", 0).otherwise(F.try_to_number(part(1), F.lit("999999")).cast("int"))
    return F.when(bare.rlike(hit), hours * 3600 + part(2).try_cast("int") * 60 + part(3).try_cast("int"))


def clock_seconds(text: Column) -> Column:
    """``HH:MM:SS`` as seconds of the day."""
    hit = r"^(\d{2}):(\d{2}):(\d{2})$"
    part = lambda i: F.regexp_extract(text, hit, i).try_cast("int")
    return F.when(text.rlike(hit), part(1) * 3600 + part(2) * 60 + part(3))


def clock_delta(a: Column, b: Column) -> Column:
    """The smallest difference of two times of day, also across midnight."""
    return F.least(F.abs(a - b), F.abs(a + 86400 - b), F.abs(a - b - 86400))


def parse_distance(text: Column) -> Column:
    """The first ``12[.,]5 km`` as a number, in either case and with any white space between."""
    return F.replace(F.regexp_extract(text, r"(?iU)([0-9]+(?:[.,][0-9]+)?)\s*km", 1), F.lit(","), F.lit(".")).try_cast("double")


def parse_rank_of(text: Column) -> Column:
    """``12 av 345`` as struct<place, count>."""
    hit = r"(?iU)([0-9]+)\s+av\s+([0-9]+)"
    return F.when(text.rlike(hit), F.struct(F.regexp_extract(text, hit, 1).try_cast("int").alias("place"), F.regexp_extract(text, hit, 2).try_cast("int").alias("count")))


def parse_rank_triple(text: Column) -> Column:
    """The first three integers as struct<overall, gender, class_>."""
    numbers = F.regexp_extract_all(text, F.lit(r"\d+"), F.lit(0))
    return F.struct(*(F.get(numbers, i).try_cast("int").alias(n) for i, n in enumerate(("overall", "gender", "class_"))))


def parse_place(text: Column) -> Column:
    return F.regexp_extract(text, r"(\d+)", 1).try_cast("int")


def opaque_id(namespace: str, race: Column, ident: Column) -> Column:
    return F.concat(F.lit("anon-"), F.substring(F.sha2(F.concat_ws("|", F.lit(namespace), race, ident), 256), 1, 20))


def list_value(headers: Column, row: Column, wanted: str) -> Column:
    """The trimmed value under a header in parallel arrays, null if empty.

    Headers are compared in lower case, trimmed, with white space collapsed.
    """
    normal = lambda h: F.lower(F.regexp_replace(stripped(h), r"(?U)\s+", " "))
    at = F.array_position(F.transform(headers, normal), F.lit(" ".join(wanted.split()).lower()))
    return F.when(at > 0, F.nullif(stripped(F.get(row, (at - 1).cast("int"))), F.lit("")))


def category_split(text: Column) -> Column:
    """``F40-44`` as struct<sex, age_category>; a band is never an age."""
    hit = r"^([FM])(\d+(?:-\d+)?\+?)?$"
    return F.when(text.rlike(hit), F.struct(F.regexp_extract(text, hit, 1).alias("sex"), F.nullif(F.regexp_extract(text, hit, 2), F.lit("")).alias("age_category")))


#: The words by which sources publish a status.
STATUS_WORDS = {
    "DNF": (r"\butgått\b", r"\bdnf\b", r"\bbrutit\b", r"\bbröt\b", r"\bretired\b", r"\bdid not finish\b"),
    "DNS": (r"\bdns\b", r"\bej start(?:at)?\b", r"\binte start(?:at)?\b", r"\bdid not start\b", r"\bno start\b"),
    "DSQ": (r"\bdsq\b", r"\bdq\b", r"\bdiskval\w*\b", r"\bdisqual\w*\b"),
}
#: Status words that are counted in raw texts.
COUNTED_WORDS = ("dnf", "dns", "dsq", "dq", "did not finish", "did not start", "disqual", "retired", "abandon", "brutit", "bröt", "brutet", "ej start", "inte start", "utgått")


def statuses(text: Column) -> Column:
    """The statuses whose words occur, in the order of ``STATUS_WORDS``; none for null."""
    return F.array_compact(F.array(*(F.when(text.rlike(f"(?iuU){'|'.join(words)}"), status) for status, words in STATUS_WORDS.items())))


def status_detect(text: Column) -> Column:
    """The one status whose words occur; null for none or several."""
    found = statuses(text)
    return F.when(F.size(found) == 1, F.get(found, 0))


def status_words(text: Column) -> Column:
    """The status words of a text in order, in lower case."""
    return F.transform(F.regexp_extract_all(text, F.lit(rf"(?iuU)\b({'|'.join(COUNTED_WORDS)})\b"), F.lit(1)), F.lower)


def _label(text: Column) -> Column:
    return F.lower(F.regexp_replace(stripped(text), r"(?U)\s+", " "))


def race_family(label: Column) -> Column:
    """A class label's family by the first rule that fits; null is an unmapped label."""
    s, km = _label(label), lambda n: rf"(?U)\b(?:{n})\s*k(?:m)?\b"
    return (
        F.when(s.contains("duo") | s.contains("relay"), "duo60").when(s.contains("ultra") | s.rlike(km("60")), "ultra60")
        .when(s.rlike(km("21|22")), "trail22").when(s.rlike(km("13|14")), "trail14").when(s.rlike(km("5")), "trail5")
    )


def nominal_km(family: Column) -> Column:
    """A family's distance."""
    return F.create_map(*(F.lit(x) for pair in {"ultra60": 60, "duo60": 60, "trail22": 22, "trail14": 14, "trail5": 5}.items() for x in pair))[family]


def historical_km(label: Column) -> Column:
    """The distance that a label itself states, of the known ones; a duo's is 60."""
    s, out = _label(label), F.when(_label(label).contains("duo"), 60)
    for n in (5, 13, 14, 21, 22, 60):  # the last one asked counts first
        out = F.when(s.rlike(rf"(?U)\b{n}\s*k(?:m)?\b"), n).otherwise(out)
    return out


def landmark(title: Column, types: Column) -> Column:
    """What a waypoint of this title and these types stands for, null for none of the known."""
    s, kinds = F.lower(F.coalesce(title, F.lit(""))), F.coalesce(types, F.array().cast("array<string>"))
    return (
        # fixed values: parts of titles
        F.when(s.contains("bengtem"), "bengtemolla").when(s.contains("vantal"), "vantalangan").when(s.contains("stenshuvud"), "stenshuvud")
        .when(s.rlike(r"(?U)\bstart\b|\bdepart\b") | F.exists(kinds, lambda t: F.lower(t) == "depart"), "start")
        .when(s.rlike("finish|mål|malgang|arriv") | F.exists(kinds, lambda t: F.lower(t).contains("arriv")), "finish")
    )


def mask_shape(text: Column) -> Column:
    """NFKC and trimmed, letters as <A>, digits as <N>, white space collapsed, the first 120 characters."""
    letters = F.regexp_replace(stripped(nfkc(text)), r"[\p{L}\p{Nl}\p{No}]+", "<A>")
    return F.substring(F.regexp_replace(F.regexp_replace(letters, r"\p{Nd}+", "<N>"), r"(?U)\s+", " "), 1, 120)


#: Cells that are shown as they are.
SAFE_LABELS = (
    r"status|resultat?|tid|time|distans|distance|klass|class|placering|rank|sträcka|etapp|leg|löpare|deltagare|medlem|member|växling|bengtemölla|"
    r"starttidspunkt|sluttidspunkt|nettotid|bruttotid|mellantid\s*\d*"
)


def safe_cell(text: Column, linked: Column | None = None) -> Column:
    """A cell's kind in angle brackets; known labels and single digits as they are."""
    bare = stripped(F.coalesce(text, F.lit("")))
    kind = (
        F.when(bare == "", "<EMPTY>").when(bare.rlike(rf"(?iuU)^(?:{SAFE_LABELS})$") | bare.rlike("^[0-9]$"), bare).when(bare.rlike(r"^[0-9]+([.,][0-9]+)?$"), "<NUMBER>")
        .when(bare.rlike(r"^[0-9]{1,2}:[0-9]{2}(:[0-9]{2})?$"), "<TIME>").when(bare.rlike(r"(?iU)^[0-9]+([.,][0-9]+)?\s*km$"), "<DISTANCE>").otherwise("<TEXT>")
    )
    return kind if linked is None else F.when(linked, "<LINKED_TEXT>").otherwise(kind)


#: The forms of published identity values.
IDENTITY_KINDS = {
    "gender_age_with_year_word": r"^(Man|Kvinna|Male|Female)\s*,\s*(\d{1,3})\s*år\b",
    "gender_age_without_year_word": r"^(Man|Kvinna|Male|Female)\s*,\s*(\d{1,3})\s*$",
    "age_category_words": r"^\s*\d{1,2}\s*[-–]\s*\d{1,2}\s+(?:män|kvinnor|men|women)\b",
    "age_category_prefix": r"^\s*(?:M|K|W|F)\s*\d{1,2}(?:\s*[-–+]\s*\d{0,2})?\s*$",
}


def identity_kind(value: Column) -> Column:
    """The first form that a value has, else ``other``."""
    bare, out = stripped(F.coalesce(value, F.lit(""))), F.lit("other")
    for kind, pattern in reversed(IDENTITY_KINDS.items()):
        out = F.when(bare.rlike(f"(?iuU){pattern}"), kind).otherwise(out)
    return out


def presentation_name(name: Column, entity: Column, bib: Column) -> Column:
    bad = name.isNull() | F.lower(F.trim(name)).isin("undefined", "null", "none", "nan", "")
    return F.when(bad, F.concat_ws(" ", entity, bib)).otherwise(name)


def format_time(seconds: Column) -> Column:
    """``[-]H:MM:SS``, halves away from zero."""
    s = F.floor(F.abs(seconds) + 0.5).cast("long")
    body = F.format_string("%d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)
    return F.when(seconds.isNotNull(), F.concat(F.when(seconds < 0, "-").otherwise(""), body))


def format_pace(pace: Column) -> Column:
    """Seconds a km as ``M:SS min/km``."""
    s = F.floor(pace + 0.5).cast("long")
    return F.when(pace.isNotNull(), F.format_string("%d:%02d min/km", F.floor(s / 60), s % 60))


#: How a status is shown.
STATUS_LABELS = {"FINISHED": "Fullföljt", "DNF": "DNF", "DNS": "Startade inte", "DSQ": "Diskvalificerad", "UNKNOWN": "Okänd status"}


def status_label(status: Column) -> Column:
    """A status as shown; others as they are, a dash for null."""
    return F.coalesce(F.create_map(*(F.lit(x) for kv in STATUS_LABELS.items() for x in kv))[status], status, F.lit("–"))


def grade_class(grade: Column) -> Column:
    """Grades in percent by six classes."""
    return F.when(grade <= -6, "steep down").when(grade <= -2, "down").when(grade < 1, "flat").when(grade < 4, "up").when(grade < 8, "climb").otherwise("steep climb")


def _of_texts(one: Callable[[str], str]) -> Callable[[Column], Column]:
    """A column function from one of texts; null stays null. The UDF is made on use, when there is a session."""

    def column(text: Column) -> Column:
        @F.pandas_udf("string")
        def run(texts: pd.Series) -> pd.Series:
            return texts.map(lambda t: None if t is None else one(t))

        return run(text)

    return column


#: Unicode normalization, which Spark lacks.
nfkc = _of_texts(lambda text: unicodedata.normalize("NFKC", text))
nfkd = _of_texts(lambda text: unicodedata.normalize("NFKD", text))
#: NFKC, case folded, white space collapsed.
normalize_name = _of_texts(lambda text: " ".join(unicodedata.normalize("NFKC", text).casefold().split()))


def slug(text: Column) -> Column:
    """NFKD, ASCII only, lower case, runs of other characters as one hyphen."""
    ascii_only = F.lower(F.regexp_replace(nfkd(text), r"[^\x00-\x7F]", ""))
    return F.btrim(F.regexp_replace(ascii_only, "[^a-z0-9]+", "-"), F.lit("-"))


def name_fingerprint(text: Column) -> Column:
    return F.sha2(normalize_name(text), 256)
