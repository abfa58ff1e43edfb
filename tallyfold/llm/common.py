"""Column texts and small helpers that the operators of this package share.

A row of ``documents`` is told from others by its ``doc_id`` and a hash of its text and source, so
that missing and repeated ids do no harm; rows alike in all of these are copies of one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.sources.shared import stored

# White space and words of the data contracts: code points 9 to 13 and 32 part words.
BLANKS = r"' \t\n\u000b\u000c\r'"
BLANK = r"[\x20\x09-\x0D]"

ROW = ["doc_id", "row_hash"]
ROW_HASH = "xxhash64(text, source) as row_hash"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(name: str, value: str, body: str) -> str:
    """SQL text of ``body`` in which ``name`` stands for ``value``, which is evaluated once.

    A plain column that is used inside a lambda could be inlined there and evaluated per element.
    """
    return f"transform(array({value}), {name} -> {body})[0]"


def words_of(text: str) -> str:
    """SQL text of the array of words of a text; NULL has none."""
    parts = f"split(coalesce({text}, ''), r'{BLANK}+')"
    return let("p", parts, "if(p[0] = '' or p[size(p) - 1] = '', filter(p, w -> w != ''), p)")


def same_row(left: DataFrame, right: DataFrame, keys: list[str] = ROW):
    """Join condition that also pairs rows whose ids are missing."""
    condition = left[keys[0]].eqNullSafe(right[keys[0]])
    for key in keys[1:]:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


#: A bitmap has 16 bits per entry, between 2^16 and 2^BITS bits (16 MB).
BITS = 27


def bitmap_bits(entries: int, most: int = BITS) -> int:
    return min(max(16, (16 * entries).bit_length()), most)


def bitmap_of(hashes: DataFrame, bits: int) -> DataFrame:
    """One stored row: ``bitmap``, an array of 2^(bits - 6) longs, with a bit for the first ``bits`` bits of each ``hash``."""
    placed = hashes.selectExpr(f"shiftrightunsigned(hash, {64 - bits}) as bit")
    words = placed.groupBy(F.expr("shiftright(bit, 6) as id")).agg(F.expr("bit_or(shiftleft(1L, int(bit & 63))) as mask"))
    # Every long has its row, so that sorted masks form the bitmap.
    every = hashes.sparkSession.range(1 << (bits - 6)).selectExpr("id", "0L as mask")
    full = words.unionByName(every).groupBy("id").agg(F.expr("bit_or(mask) as mask"))
    return stored(full.agg(F.expr("transform(array_sort(collect_list(struct(id, mask))), s -> s.mask) as bitmap")), "bitmap")


def in_bitmap(bitmap: str, hashed: str, bits: int) -> str:
    """SQL test of a hash's bit. A set bit may be another entry's; one not set proves that the hash has no entry."""
    place = f"shiftrightunsigned({hashed}, {64 - bits})"
    return f"getbit({bitmap}[int(shiftright({place}, 6))], int({place} & 63)) = 1"
