"""Hash partition numbers as the event bus computes them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

_HALF, _FULL = 2**31, 2**32


def _signed(x: Column) -> Column:
    return F.pmod(x + F.lit(_HALF), F.lit(_FULL)) - F.lit(_HALF)


def _units(char: Column) -> Column:
    """A character's UTF-16 code units: one, or two above U+FFFF."""
    point = F.ascii(char).cast("long")
    over = point - 0x10000
    pair = F.array(F.lit(0xD800).cast("long") + F.shiftright(over, 10), F.lit(0xDC00).cast("long") + over.bitwiseAND(F.lit(0x3FF).cast("long")))
    return F.when(point > 0xFFFF, pair).otherwise(F.array(point))


@F.pandas_udf(LongType())
def string_hash(texts: pd.Series) -> pd.Series:
    """h * 31 + unit over the UTF-16 code units, in signed 32-bit arithmetic; 0 for an empty string. A batch's units are
    weighted by powers of 31 and summed by text, all at once."""
    raw = [b"" if t is None else t.encode("utf-16-le", "surrogatepass") for t in texts]
    n = np.array([len(r) // 2 for r in raw], dtype=np.int64)
    units = np.frombuffer(b"".join(raw), dtype="<u2").astype(np.uint32)
    ends = np.cumsum(n)
    powers = np.cumprod(np.append(np.uint32(1), np.full(max(0, int(n.max(initial=0)) - 1), 31, dtype=np.uint32)), dtype=np.uint32)
    weighted = units * powers[np.repeat(ends, n) - 1 - np.arange(len(units))]
    out, full = np.zeros(len(raw), dtype=np.uint32), np.flatnonzero(n)
    if len(full):
        out[full] = np.add.reduceat(weighted, (ends - n)[full], dtype=np.uint32)
    return pd.Series(out.view(np.int32).astype(np.int64)).astype("Int64").mask(texts.isna().to_numpy())


def _member_hash(text: Column) -> Column:
    """The same for a member of an array, where only expressions can be."""
    units = F.flatten(F.transform(F.filter(F.split(text, ""), lambda c: c != ""), _units))
    return F.aggregate(units, F.lit(0).cast("long"), lambda h, c: _signed(h * 31 + c))


def key_hash(key: Column, kind: str = "string") -> Column:
    """The hash of a partition key whose type is named: of a string its string_hash, of a number itself, of an array the sum of
    its members' hashes."""
    if kind.startswith("array<"):
        return F.aggregate(key, F.lit(0).cast("double" if kind[6:-1] in ("float", "double") else "long"), lambda h, x: h + (_member_hash(x) if kind[6:-1] == "string" else key_hash(x, kind[6:-1])))
    return string_hash(key) if kind == "string" else key


def clamp(n: int) -> int:
    """Instances are held to 1 .. 20."""
    return max(1, min(20, n))


def partition_of(key: Column, n: int, kind: str = "string") -> Column:
    """0 .. n - 1 for a key; n is held to 1 .. 20."""
    return F.pmod(F.abs(key_hash(key, kind)), F.lit(clamp(n))).cast("int")
