"""A Bloom filter of keys as a table of bit blocks, tested by a broadcast join before rows are shuffled.

A key sets ``PROBES`` bits of one 64-bit word; ``WORDS`` words are a block, which is a row. The blocks are built by one aggregate over the
keys, so nothing but the finished filter leaves the executors. Its size follows from the measured number of keys and never
exceeds ``MOST_BYTES``; where that leaves fewer than ``LEAST_BITS`` bits a key, no filter is made, since it would let most rows pass.
No key is lost; some others pass, so an exact join has to follow.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.operators.staging import materialize

BITS, LEAST_BITS = 24, 6
PROBES = 4
WORDS = 16
MOST_BYTES = 48 << 20


@dataclass(frozen=True)
class PairFilter:
    """Blocks ``(_block, _words)`` of a filter over keys of as many columns as given when it was built."""

    blocks: DataFrame
    number: int

    def keep(self, rows: DataFrame, *key: str) -> DataFrame:
        """The rows whose key may be in the filter; they don't move."""
        return self._probed(rows, "inner", key).where("_found").drop("_found")

    def part(self, rows: DataFrame, *key: str) -> tuple[DataFrame, DataFrame]:
        """The rows whose key may be in the filter, and those whose key is not; they don't move."""
        probed = self._probed(rows, "left", key)
        found = F.coalesce("_found", F.lit(False))
        return probed.where(found).drop("_found"), probed.where(~found).drop("_found")

    def _probed(self, rows: DataFrame, how: str, key: tuple[str, ...]) -> DataFrame:
        hashed = F.xxhash64(*key)
        word = F.element_at("_words", (_word(hashed) + 1).cast("int"))
        probed = rows.join(F.broadcast(self.blocks), _block(hashed, self.number) == F.col("_block"), how)
        return probed.withColumn("_found", word.bitwiseAND(_mask(hashed)) == _mask(hashed)).drop("_block", "_words")


def filter_of(keys: DataFrame, *key: str, bits: int = BITS, most_bytes: int = MOST_BYTES, count: int | None = None) -> PairFilter | None:
    """A filter of the stored ``keys``, with ``bits`` bits a key; None if it would be too full at ``most_bytes``."""
    count = keys.count() if count is None else count
    block_bits = WORDS * 64
    number = max(1, min(-(-count * bits // block_bits), most_bytes * 8 // block_bits))
    if number * block_bits < LEAST_BITS * count:
        return None
    hashed = F.xxhash64(*key)
    # blocks follow from a hash, so they are even, and a key travels as three numbers
    marked = keys.select(_block(hashed, number).alias("_block"), _word(hashed).alias("_word"), _mask(hashed).alias("_mask")).repartition("_block")
    words = [F.bit_or(F.when(F.col("_word") == k, F.col("_mask")).otherwise(F.lit(0).cast("long"))).alias(f"_w{k}") for k in range(WORDS)]
    blocks = marked.groupBy("_block").agg(*words).select("_block", F.array(*[f"_w{k}" for k in range(WORDS)]).alias("_words"))
    return PairFilter(materialize(blocks, "pair-filter"), number)


def _block(hashed: Column, number: int) -> Column:
    return F.pmod(F.shiftrightunsigned(hashed, 33), F.lit(number).cast("long"))


def _word(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, 24).bitwiseAND(F.lit(WORDS - 1).cast("long"))


def _mask(hashed: Column) -> Column:
    one = F.lit(1).cast("long")
    bits = [F.call_function("shiftleft", one, F.shiftrightunsigned(hashed, 6 * k).bitwiseAND(F.lit(63).cast("long")).cast("int"))
            for k in range(PROBES)]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    return mask
