"""The url filter against a plain version of its rules, features and scores, and on labels that it hasn't seen."""

import math
import re
import zlib
from functools import lru_cache

import __spark_entry__
from racelab.llm import urls

SF = "/root/testdata/sf0.001"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return host.translate({c: c + 32 for c in range(65, 91)}), re.split("[?#]", rest[len(host) :], maxsplit=1)[0]


def rule_of(host, path):
    fitting = []
    for verdict, rule in urls.RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fitting.append((len(rule), len(name), verdict, rule))
    return max(fitting)[2:] if fitting else (None, None)


def grams(host, path):
    marked = (f"^{host}$", f"<{path}>")
    return {t[i : i + n] for t in marked for n in urls.GRAMS for i in range(max(len(t) - n + 1, 1))}


class Plain:
    """The fitted regression, by features looked up one by one."""

    def __init__(self, model):
        self.weights, self.bias = model.coefficients.toArray(), model.intercept
        self.index = lru_cache(maxsize=None)(urls.hashing().indexOf)

    def score(self, host, path):
        return 1 / (1 + math.exp(-self.bias - sum(self.weights[i] for i in {self.index(g) for g in grams(host, path)})))


def test_against_plain_version(spark):
    made = ["x://Example.ORG/en/1?a=b", "s://a.com#x", "q", None, "h://é.net/ü/😀", "h://www.lucky-casino.com/xxx/buy?id=1", "h:///no/host", "h://com/de/", "a://xcom/de/1", "://com/fr/de"]
    given = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()} | {-i: u for i, u in enumerate(made, 1)}
    pages = spark.createDataFrame(list(given.items()), "page_id long, url string")
    plain = Plain(urls.fitted(urls.labelled_urls(spark)))
    out = {r["page_id"]: r for r in urls.judged(pages).collect()}
    assert len(out) == len(given)
    for i, url in given.items():
        host, path = parts(url)
        verdict, rule = rule_of(host, path)
        want = plain.score(host, path)
        assert (out[i]["host"], out[i]["path"], out[i]["rule"]) == (host, path, rule) and abs(out[i]["score"] - want) < 1e-9, url
        assert out[i]["verdict"] == (verdict or ("block" if want >= 0.5 else "allow"))
    assert out[-6]["verdict"] == "block"
    queried = {r["page_id"]: r for r in __spark_entry__.queries()["op8_url_filters"](spark, SF).collect()}
    assert all(queried[i][c] == out[i][c] for i in queried for c in ("host", "path", "rule", "verdict"))


def test_held_out_labels(spark):
    """Trained on four fifths of the labelled hosts, right on the others."""
    rows = [(r["host"], r["path"], r["blocked"], zlib.crc32(r["host"].encode()) % 5) for r in urls.labelled_urls(spark).collect()]
    right = n = 0
    for fold in range(5):
        plain = Plain(urls.fitted(spark.createDataFrame([r[:3] for r in rows if r[3] != fold], "host string, path string, blocked double")))
        unseen = [r for r in rows if r[3] == fold]
        right += sum((plain.score(h, p) >= urls.THRESHOLD) == (b == 1) for h, p, b, _ in unseen)
        n += len(unseen)
    print(f"held-out accuracy {right / n:.3f} of {n}")
    assert n == len(rows) and right / n > 0.9
