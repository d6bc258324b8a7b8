"""Bank account numbers beside other capitals and digits."""

from pyspark.sql import functions as F

from racelab.llm import pii

DE, GB, FR, NO = "DE89 3704 0044 0532 0130 00", "GB29NWBK60161331926819", "FR14 2004 1010 0505 0001 3M02 606", "NO93 8601 1117 947"
#: An unregistered country code with a valid check sum.
ZZ = next(x for k in range(98) if int("".join(str(int(c, 36)) for c in f"1234567890123ZZ{k:02}")) % 97 == 1 for x in [f"ZZ{k:02} 1234 5678 9012 3"])
#: Text, and the numbers in it.
CASES = [
    (f"IBAN {DE} BIC COBADEFF", [DE]),
    (f"IBAN {DE.replace(' ', '')} 2024", [DE.replace(" ", "")]),
    (f"IBAN {DE}, The end", [DE]),
    (f"{DE} {GB} {FR} {NO} 12 AB", [DE, GB, FR, NO]),
    (f"é😀 REF AB12 3456 7890 {DE} EUR 100", [DE]),
    (f"REF AB12 3456 {NO} AND {GB} TOO", [NO, GB]),
    (f"{ZZ} XY 99", []),
    (f"bank {ZZ} XY 99", [ZZ]),
    (f"{DE[:-1]}1 BIC COBADEFF", []),
    (f"X{DE} BIC", []),
    (f"{DE.replace(' ', '')}A2 BIC", []),
    ("AB12 3456", []),
    ("A1 " * 500, []),
    ("", []),
]


def test_accounts_beside_capitals_and_digits(spark):
    rows = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(CASES)], "doc_id long, text string")
    found = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"] if s["kind"] == "iban"] for r in pii.find(rows).collect()}
    clean = {r["doc_id"]: r["text"] for r in pii.redacted(rows).collect()}
    for i, (text, numbers) in enumerate(CASES):
        assert [text[a:b] for a, b in found[i]] == numbers, text
        assert not any(n in clean[i] for n in numbers)
    assert clean[0] == "IBAN [IBAN] BIC COBADEFF"


def test_whole_run_still_counts(spark):
    """Where a run of groups passes as a whole, it is found whatever its country's length."""
    run = next(x for k in range(98) if int("".join(str(int(c, 36)) for c in f"12345678901234DE{k:02}")) % 97 == 1 for x in [f"DE{k:02}12345678901234"])
    got = spark.createDataFrame([(f"IBAN {run}.",)], "text string").select(F.size(pii.spans_of(F.col("text"), "iban"))).first()[0]
    assert got == 1


#: Text, kind and score of each span of an added kind, and of base kinds where context counts.
SCORED = [
    ("His SSN is 123-45-6789.", [("ssn", 11, 22, 0.6)]),
    ("part 123-45-6789 of the plan", []),
    ("123-45-6789 and 987-65-4321 are their tax id, he said", [("ssn", 0, 11, 0.6), ("ssn", 16, 27, 0.6)]),
    ("SSN" + " " * 38 + "123-45-6789", []),
    ("SSN" + " " * 37 + "123-45-6789", [("ssn", 40, 51, 0.6)]),
    (f"{GB} is there", [("iban", 0, 22, 0.6)]),
    (f"to the bank account {DE} or {GB} now", [("iban", 20, 47, 0.9), ("iban", 51, 73, 0.9)]),
    (f"{DE} {'x' * 32} bank", [("iban", 0, 27, 0.9)]),
    (f"{DE} {'x' * 40} bank", [("iban", 0, 27, 0.6)]),
    (f"{ZZ} alone", []),
    (f"{ZZ} is my account", [("iban", 0, 21, 0.6)]),
    ("host 10.0.0.1, then 10.0.0.2", [("ip", 5, 13, 0.9), ("ip", 20, 28, 0.9)]),
    ("x 10.0.0.1", [("ip", 2, 10, 0.6)]),
]


def test_scores(spark):
    rows = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(SCORED)], "doc_id long, text string")
    found = {r["doc_id"]: [(s["kind"], s["start"], s["end"], round(s["score"], 6)) for s in r["spans"]] for r in pii.find(rows).collect()}
    assert found == {i: want for i, (_, want) in enumerate(SCORED)}


def test_many_matches(spark):
    """Time in proportion: 50,000 addresses with cards and accounts between them in one text."""
    one = f"10.1.2.3 a@b.cd 4111 1111 1111 1111 tel. +1 (068) 555-2748, bank {GB}\n"
    text = "10.0.0.1 " * 40_000 + one * 10_000
    row = spark.createDataFrame([(text,)], "text string").select(pii.spans(F.col("text")).alias("s"), "text").select("s", pii.redact(F.col("text"), F.col("s")).alias("clean")).first()
    assert [sum(s["kind"] == k for s in row["s"]) for k in pii.KINDS] == [10_000, 50_000, 10_000, 10_000, 10_000, 0]
    assert row["clean"] == "[IP] " * 40_000 + "[IP] [EMAIL] [CARD] tel. [PHONE], bank [IBAN]\n" * 10_000
    assert all(text[s["start"] : s["end"]] == {"email": "a@b.cd", "card": "4111 1111 1111 1111", "iban": GB}.get(s["kind"], text[s["start"] : s["end"]]) for s in row["s"])
