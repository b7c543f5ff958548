"""Texts of Arrow batches as byte arrays: slices of bounded size, words, and their hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

SLICE_BYTES = 1 << 20
LONG_WORD = 256  # longer words are hashed by blake2b, as sums of powers are weak for very long strings

_random = np.random.Generator(np.random.PCG64(20240607))
BYTE_VALUES = _random.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 2**64)
IS_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])

_powers = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** n modulo 2 ** 64."""
    known = _powers.get(base)
    if known is None or len(known) <= n:
        size = max(1 << 16, 1 << int(n).bit_length())
        known = np.full(size + 1, np.uint64(base))
        known[0] = 1
        _powers[base] = known = np.multiply.accumulate(known)
    return known[: n + 1]


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Texts:
    """Some texts in one byte array: ``data``, and the ``offsets`` of their beginnings and of the end."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
        _, offsets, data = texts.buffers()
        self.offsets = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
        first, last = int(self.offsets[0]), int(self.offsets[-1])
        whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        self.data, self.offsets = whole[first:last], self.offsets - first

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def bytes(self) -> Iterator[bytes]:
        for i in range(len(self)):
            yield self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sum of one value for each byte, by text."""
        return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[self.offsets])


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+``: byte ranges, index of the text, and number of words by text."""

    def __init__(self, texts: Texts):
        data = texts.data
        inside = ~IS_SPACE[data]
        begins = np.zeros(len(data) + 1, bool)
        begins[texts.offsets] = True
        before = np.ones(len(data), bool)  # no word goes on from the byte before
        before[1:] = ~inside[:-1]
        before |= begins[:-1]
        self.starts = np.flatnonzero(inside & before)
        after = np.ones(len(data), bool)
        after[:-1] = ~inside[1:]
        after |= begins[1:]
        self.ends = np.flatnonzero(inside & after) + 1
        self.text = np.searchsorted(texts.offsets, self.starts, "right") - 1
        self.counts = np.bincount(self.text, minlength=len(texts)).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.inside, self.texts = inside, texts

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        """A 64-bit name for each word; equal words have equal names."""
        data, n = self.texts.data, len(self.texts.data)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_VALUES[data] * powers(BASE, n)[:n])])
        names = mix((sums[self.ends] - sums[self.starts]) * powers(INVERSE, n)[self.starts])
        for i in np.flatnonzero(self.ends - self.starts >= LONG_WORD):
            word = data[self.starts[i]:self.ends[i]].tobytes()
            names[i] = np.uint64(int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little"))
        return names

    def windows(self, names: np.ndarray, size: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
        """First word of each window of ``size`` words inside one text, and a hash of its words."""
        at = np.arange(max(0, len(names) - size + 1))
        at = at[self.text[at] == self.text[at + size - 1]] if len(at) else at
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(names * powers(base, len(names))[: len(names)])])
        inverse = powers(pow(base, -1, 2**64), len(names))
        return at, mix((sums[at + size] - sums[at]) * inverse[at])


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Parts of a batch whose texts have about ``size`` bytes, or one text if that is longer; null is empty."""
    text = batch.column(batch.schema.get_field_index(column))
    lengths = np.asarray(pc.fill_null(pc.binary_length(text), 0))
    before = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(before, before[at] + size, "right")) - 1)
        yield batch.slice(at, to - at), Texts(pc.fill_null(text.slice(at, to - at), ""))
        at = to


def by_slices(df: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``work(part of a batch, its texts)`` gives a dictionary of columns; ``df`` has a column ``text``."""
    names, kinds = arrow_fields(schema)

    def run(batches):
        for batch in batches:
            for part, texts in slices(batch):
                found = work(part, texts)
                yield pa.RecordBatch.from_arrays([as_array(found[n], k) for n, k in zip(names, kinds)], names=names)

    return df.mapInArrow(run, schema)


def with_struct(df: DataFrame, work: Callable, schema: str) -> tuple[DataFrame, str]:
    """``df`` with the columns that ``work`` makes of the text in one struct column, and the name of that column."""
    name = "made"
    while name in df.columns:
        name += "_"
    fields, kinds = arrow_fields(schema)

    def run(batches):
        for batch in batches:
            for part, texts in slices(batch):
                found = work(part, texts)
                made = pa.StructArray.from_arrays([as_array(found[n], k) for n, k in zip(fields, kinds)], names=fields)
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=[*part.schema.names, name])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, T.StructType.fromDDL(schema))])), name


_SCALARS = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64(), "binary": pa.binary()}


def _arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow_type(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, _arrow_type(f.dataType)) for f in kind.fields])
    return _SCALARS[kind.simpleString()]


def arrow_fields(schema: str) -> tuple[list[str], list[pa.DataType]]:
    """Names and Arrow types of a schema; values are made with them, so that a part without any value fits too."""
    fields = T.StructType.fromDDL(schema).fields
    return [f.name for f in fields], [_arrow_type(f.dataType) for f in fields]


def as_array(values, kind: pa.DataType | None = None) -> pa.Array:
    """Any column of values as one Arrow array."""
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    if not isinstance(values, pa.Array):
        return pa.array(values, kind)
    return values if kind is None or values.type == kind else values.cast(kind)


def text_rows(docs: DataFrame, *columns: str) -> DataFrame:
    """The wanted columns and the text, with null as empty text."""
    return docs.select(*columns, F.coalesce(F.col("text"), F.lit("")).alias("text"))


def uint64_hex(column: Column) -> Column:
    return F.lpad(F.lower(F.hex(column)), 16, "0")
