"""Masking inside JSON documents of any shape, which Spark's functions can't walk."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

NAMES, DIRECT = ("name", "member_name"), ("bib", "email", "phone")
SHOWN = "Protected participant"


def masked(value):
    """The value with names replaced and direct identifiers null, and how many changed."""
    if isinstance(value, list):
        parts = [masked(x) for x in value]
        return [p[0] for p in parts], sum(p[1] for p in parts)
    if not isinstance(value, dict):
        return value, 0
    out, changes = {}, 0
    for k, v in value.items():
        if k in NAMES and isinstance(v, str):
            out[k], n = SHOWN, int(v != SHOWN)
        elif k in DIRECT:
            out[k], n = None, int(v is not None)
        else:
            out[k], n = masked(v)
        changes += n
    return out, changes


def mask_nested(document: Column) -> Column:
    """struct<clean, changes> of a JSON text; what isn't JSON, or null, gives nulls."""

    def one(text: str | None) -> dict:
        try:
            clean, changes = masked(json.loads(text))
        except (TypeError, ValueError):
            return {"clean": None, "changes": None}
        return {"clean": json.dumps(clean, ensure_ascii=False), "changes": changes}

    @F.pandas_udf("struct<clean:string,changes:int>")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(t) for t in texts], columns=["clean", "changes"]).astype({"changes": "Int32"})

    return run(document)
