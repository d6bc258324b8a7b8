"""Personal data in texts, with DataFrame functions only.

Regular expressions propose spans, validators confirm them (part sizes of addresses, the Luhn sum of card numbers, the
mod-97 sum of bank accounts), and context words nearby raise a span's score. The base kinds (email, ip, card, phone)
stay once confirmed; bank accounts and national identity numbers are added if their score reaches ``THRESHOLD``.

Offsets are code points, the end exclusive. Matches are leftmost and don't overlap within a kind; kinds may overlap.
Null and empty texts have no spans. All work stays within a row, and time grows little more than in proportion to a
text's length and matches; repeated rows repeat. ``find`` reads doc_id and text only; ``redacted`` keeps all columns and
replaces each span, overlapping ones together, by its kind in brackets.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racelab.llm.common import let, running, table

THRESHOLD = 0.5
#: Context words count within so many code points around a span.
NEAR = 40
CONTEXT_BONUS = 0.3
#: Where a bank account number passes mod-97 without a registered country's length: context has to confirm it.
UNREGISTERED = 0.3
_LOCAL, _LABEL = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]"
#: What follows the first four characters of a bank account number: at most 34 characters in all, spaces not counted.
_REST = r"(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])"
#: Registered length of bank account numbers by country.
ACCOUNT_LENGTHS = {code: n for n, codes in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}.items() for code in codes.split()}
#: Kinds in order: pattern, what a text with a match contains, score before context, context words. Possessive
#: quantifiers and the looks behind change no match; they keep the search linear in long runs of digits or letters.
KINDS: dict[str, tuple[str, str | None, float, str]] = {
    "email": (rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++", "@", 0.8, r"(?i)\be-?mail|\bcontact|\bwrite to|@"),
    "ip": (r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", ".", 0.6, r"(?i)\bip\b|\bhost|\bserver|\baddress"),
    "card": (r"[0-9](?:[\x20-]?[0-9]){12,}+", None, 0.7, r"(?i)\bcard|\bvisa\b|\bcredit|\bdebit|\bpayment"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.7, r"(?i)\bphone|\bcall\b|\btel\b|\bmobile|\bfax\b"),
    # the start of an account number only: where it ends, account_at() decides
    "iban": (rf"(?<![A-Za-z0-9])[A-Z]{{2}}[0-9]{{2}}(?={_REST})", None, 0.6, r"(?i)\biban\b|\bbank|\baccount|\btransfer"),
    "ssn": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", 0.3, r"(?i)\bssn\b|\bsocial security|\btax id|\btaxpayer"),
}
BASE = ("email", "ip", "card", "phone")
_BYTE = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def mod97(value: Column) -> Column:
    """The remainder of a bank account number as its check defines it: 1 for a valid one."""
    bare = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(bare, F.lit(5)), F.substr(bare, F.lit(1), F.lit(4)))

    def step(sum_: Column, c: Column) -> Column:
        letter = F.ascii(c) >= 65
        return (sum_ * F.when(letter, 100).otherwise(10) + F.ascii(c) - F.when(letter, 55).otherwise(48)) % 97

    return F.aggregate(F.split(turned, ""), F.lit(0), step)


def _valid(kind: str) -> Callable[[Column], Column]:
    if kind == "ip":
        return lambda m: m.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return lambda m: let(_digits(m), lambda d: F.length(d).between(13, 19) & F.call_function("luhn_check", d))
    if kind == "phone":
        return lambda m: F.length(_digits(m)).between(9, 15)
    return lambda m: F.lit(True)


def _registered_length(number: Column) -> Column:
    """Whether a bank account number is as long as its country's are; false for countries that have none."""
    lengths = F.create_map(*(F.lit(x) for pair in ACCOUNT_LENGTHS.items() for x in pair))
    registered = F.try_element_at(lengths, F.substr(number, F.lit(1), F.lit(2)))
    return F.coalesce(F.length(F.replace(number, F.lit(" "), F.lit(""))) == registered, F.lit(False))


def account_in(run: Column) -> Column:
    """The bank account number at the start of a text, null if none is there.

    It ends at a space or where the run of groups ends. Of the ends that pass mod-97 the one of the country's registered
    length counts, then the longest; short of the run's end, a registered country's number has its registered length.
    """
    lengths = F.create_map(*(F.lit(x) for pair in ACCOUNT_LENGTHS.items() for x in pair))

    def best(groups: Column) -> Column:
        ends = F.transform(F.sequence(F.lit(1), F.size(groups)), lambda i: F.concat_ws(" ", F.slice(groups, 1, i)))
        registered = F.try_element_at(lengths, F.substr(groups[0], F.lit(1), F.lit(2)))
        bare = lambda m: F.length(F.replace(m, F.lit(" "), F.lit("")))
        fits = lambda m: F.coalesce(bare(m) == registered, F.lit(False))
        whole = lambda m: F.length(m) == F.length(F.concat_ws(" ", groups))
        passed = F.filter(ends, lambda m: F.when((bare(m) >= 15) & (registered.isNull() | fits(m) | whole(m)), mod97(m) == 1).otherwise(False))
        return let(passed, lambda p: F.coalesce(F.try_element_at(F.filter(p, fits), F.lit(1)), F.try_element_at(p, F.lit(-1))))

    return let(F.split(F.regexp_extract(run, rf"^[A-Z]{{2}}[0-9]{{2}}{_REST}", 0), " "), best)


#: The shortest match of any kind has so many characters, so this many pieces hold what lies within a distance.
_SHORTEST, _ACCOUNT = 4, 65


def _before(pieces: Column, i: Column, n: int) -> Column:
    """The last ``n`` characters before match ``i``; pieces are a text's gaps, each with the match behind it."""
    most = n // _SHORTEST + 1
    earlier = F.slice(pieces, F.greatest(i - most, F.lit(0)) + 1, F.least(i, F.lit(most)))
    joined = F.array_join(F.transform(earlier, lambda x: F.concat(F.right(x["g"], F.lit(n)), F.right(x["m"], F.lit(n)))), "")
    return F.right(F.concat(joined, F.right(pieces[i]["g"], F.lit(n))), F.lit(n))


def _after(pieces: Column, i: Column, n: int) -> Column:
    """The first ``n`` characters after match ``i``."""
    later = F.slice(pieces, i + 2, F.lit(n // _SHORTEST + 1))
    return F.left(F.array_join(F.transform(later, lambda x: F.concat(F.left(x["g"], F.lit(n)), F.left(x["m"], F.lit(n)))), ""), F.lit(n))


def _accounts(pieces: Column, found: Column) -> Column:
    """The account numbers at the found starts, without those that begin within the one before."""

    def account(s: Column) -> Column:
        number = account_in(F.concat(s["m"], _after(pieces, s["i"], _ACCOUNT)))
        return let(number, lambda m: F.struct(s["i"].alias("i"), m.alias("m"), s["start"].alias("start"), (s["start"] + F.length(m)).alias("end")))

    def apart(numbers: Column) -> Column:
        ends = running(numbers, F.lit(0), "int", lambda end, s: F.when(s["start"] >= end, s["end"]).otherwise(end))
        return let(ends, lambda e: F.filter(numbers, lambda s, j: s["start"] >= F.coalesce(F.get(e, j - 1), F.lit(0))))

    return let(F.filter(F.transform(found, account), lambda s: s["m"].isNotNull()), apart)


def spans_of(text: Column, kind: str) -> Column:
    """array<struct<kind, start, end, score>> of a kind's confirmed spans, by start. ``text`` is not null."""
    pattern, sign, score, context = KINDS[kind]
    none = F.array().cast("array<struct<kind:string,start:int,end:int,score:double>>")
    valid = _valid(kind)

    def placed(pieces: Column) -> Column:
        # what stands between the matches gives their places
        ends = running(pieces, F.lit(0), "int", lambda at, x: at + F.length(x["g"]) + F.length(x["m"]))

        def scored(s: Column) -> Column:
            beyond = F.length(s["m"]) - F.length(pieces[s["i"]]["m"])  # an account goes on behind its match
            right = F.substr(_after(pieces, s["i"], NEAR + _ACCOUNT), beyond + 1, F.lit(NEAR)) if kind == "iban" else _after(pieces, s["i"], NEAR)
            around = F.concat_ws(" ", _before(pieces, s["i"], NEAR), right)
            start_score = F.when(_registered_length(s["m"]), score).otherwise(UNREGISTERED) if kind == "iban" else F.lit(score)
            value = start_score + F.when(around.rlike(context), CONTEXT_BONUS).otherwise(0.0)
            return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), value.alias("score"))

        def confirmed(ends_: Column) -> Column:
            one = lambda x, i: F.struct(i.alias("i"), x["m"].alias("m"), (ends_[i] - F.length(x["m"])).alias("start"), ends_[i].alias("end"))
            found = F.slice(F.transform(pieces, one), 1, F.size(pieces) - 1)  # behind the last gap there is no match
            kept = let(found, lambda f: _accounts(pieces, f)) if kind == "iban" else F.filter(found, lambda s: valid(s["m"]))
            return F.transform(kept, scored)

        kept = let(ends, confirmed)
        return kept if kind in BASE else F.filter(kept, lambda s: s["score"] >= THRESHOLD)

    def with_gaps(matches: Column) -> Column:
        pieces = F.arrays_zip(F.concat(matches, F.array(F.lit(""))).alias("m"), F.split(text, pattern, -1).alias("g"))
        return F.when(F.size(matches) > 0, let(pieces, placed)).otherwise(none)

    found = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), with_gaps)
    return F.when(F.contains(text, F.lit(sign)), found).otherwise(none) if sign else found


def spans(text: Column) -> Column:
    """All spans of a text, by kind and start."""
    text = F.coalesce(text, F.lit(""))
    return F.concat(*(spans_of(text, kind) for kind in KINDS))


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of every row."""
    return docs.select("doc_id", spans(F.col("text")).alias("spans"))


#: Texts are cut into blocks of so many characters to take parts of them.
_BLOCK = 512


def _part(blocks: Column, start: Column, end: Column) -> Column:
    """The characters from ``start`` to ``end`` of a text cut into blocks."""
    first, last = F.floor(start / _BLOCK).cast("int"), F.floor((end - 1) / _BLOCK).cast("int")

    def of(k: Column) -> Column:
        left = F.greatest(start - k * _BLOCK, F.lit(0))
        return F.substr(blocks[k], left + 1, F.least(end - k * _BLOCK, F.lit(_BLOCK)) - left)

    return F.when(start < end, F.array_join(F.transform(F.sequence(first, last), of), "")).otherwise("")


def redact(text: Column, found: Column) -> Column:
    """The text with each span replaced by its kind; overlapping spans as one, by the first's kind."""

    def of(ordered: Column, ends: Column, blocks: Column) -> Column:
        def one(s: Column, i: Column) -> Column:
            before = F.coalesce(F.get(ends, i - 1), F.lit(0))
            return F.when(s["start"] >= before, F.concat(_part(blocks, before, s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise("")

        rest = _part(blocks, F.element_at(ends, -1), F.length(text))
        return F.concat(F.array_join(F.transform(ordered, one), ""), rest)

    ordered = F.sort_array(F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    ends = lambda o: running(o, F.lit(0), "int", lambda end, s: F.greatest(end, s["end"]))
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0))
    return F.when(F.size(found) > 0, let(ordered, lambda o: let(ends(o), lambda e: let(blocks, lambda b: of(o, e, b))))).otherwise(text)


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced in its texts; a null text stays null."""
    text = F.col("text")
    return docs.withColumn("text", F.when(text.isNotNull(), let(spans(text), lambda found: redact(text, found))))


def _joined(found: Column) -> Column:
    return F.concat_ws(",", F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def _count(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")


def op10_pii(spark, sf_dir: str) -> DataFrame:
    def digest(found: Column) -> Column:
        base = F.filter(found, lambda s: s["kind"].isin(*BASE))
        counts = [_count(found, kind).alias(f"n_{kind}") for kind in BASE]
        return F.struct(*counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(found).alias("spans"))

    rows = table(spark, sf_dir, "documents").select("doc_id", let(spans(F.col("text")), digest).alias("r"))
    return rows.select("doc_id", "r.*")
