"""JSON values: a digest that is equal for equal values, and a strict parse on the JVM side."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from decimal import MAX_EMAX, Context, Decimal

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Digest of the empty list and all that counts as it.
EMPTY = 0


def with_variant(df: DataFrame, text: Column, out: str) -> DataFrame:
    """df with the column out: the VARIANT of a JSON text that is valid as a whole, else NULL.

    try_parse_json stops after the first value and so accepts text behind it. Here the text is put into an object
    before a member that holds its own hash, which is found only if the text ended where its value did. The parse is
    behind a generator of one row: filters and projections on out can't be pulled below it and repeat the parse.
    """
    mark = F.hex(F.xxhash64(text))
    whole = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit(',"end":"'), mark, F.lit('"}')))
    once = df.select("*", mark.alias("__mark"), F.explode(F.array(whole)).alias("__whole"))
    ended = F.try_variant_get("__whole", "$.end", "string") == F.col("__mark")
    return once.withColumn(out, F.when(ended, F.try_variant_get("__whole", "$.v", "variant"))).drop("__mark", "__whole")


_LITERAL = re.compile(r"(-?)(\d+)(?:\.(\d+))?(?:[eE]([+-]?\d+))?")


class _Exact:
    """A number by its digits without zeros at either end, and its exponent: equal exactly for equal numbers."""

    __slots__ = ("text",)

    def __init__(self, text: str) -> None:
        self.text = text


def _number(text: str) -> object:
    """A number as its exact value: 1, 1.0 and 1e0 are one. No digit and no exponent is too many."""
    if len(text) < 16 and text.lstrip("-").isdigit():
        return int(text)
    sign, whole, part, power = _LITERAL.fullmatch(text).groups()
    digits = (whole + (part or "")).lstrip("0")
    if not digits:
        return 0
    bare = digits.rstrip("0")
    shift = len(digits) - len(bare) - len(part or "")
    # Decimal, as int() reads and str() writes a few thousand digits only
    wide = Context(prec=len(power or "") + 20, Emax=MAX_EMAX)
    exponent = wide.add(wide.create_decimal(power or "0"), Decimal(shift))
    if 0 <= exponent < 16 and len(bare) + int(exponent) < 16:
        return int(sign + bare + "0" * int(exponent))
    return _Exact(f"{sign}{bare}e{exponent:f}")


def _refuse(text: str) -> object:
    raise ValueError(text)


def _present(pairs: dict) -> dict:
    return {"\0" + k if k[:1] == "\0" else k: v for k, v in pairs.items() if v is not None}


_DECODER = json.JSONDecoder(object_hook=_present, parse_float=_number, parse_int=_number, parse_constant=_refuse)


def _written(value: _Exact) -> dict:
    return {"\0": value.text}  # no object of a document has this name alone, see _present


def value_digest(text: str | None) -> int:
    """64-bit digest of a JSON text as a value; equal values in any spelling have equal digests.

    The order of keys does not count, that of list elements does; a key with null equals an absent key; NULL, blank
    text, `null` and `[]` are EMPTY. A text that is not JSON, or too deep to be read, is digested as text.
    """
    if text is None or not text.strip():
        return EMPTY
    try:
        value = _DECODER.decode(text)
        if value is None or value == []:
            return EMPTY
        plain = json.dumps(value, sort_keys=True, ensure_ascii=False, separators=(",", ":"), default=_written)
    except (ValueError, RecursionError):
        plain = "not json\x00" + text
    return int.from_bytes(hashlib.blake2b(plain.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True) or 1


def digest_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the column json of each batch by its digest."""
    for batch in batches:
        at = batch.schema.get_field_index("json")
        columns = [pa.array(map(value_digest, c.to_pylist()), pa.int64()) if i == at else c for i, c in enumerate(batch.columns)]
        yield pa.RecordBatch.from_arrays(columns, ["digest" if n == "json" else n for n in batch.schema.names])
