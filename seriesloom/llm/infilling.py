"""Fill-in-the-middle examples by a pipeline of ``pyarrow.compute`` calls over whole batches.

A text is cut into units: a word with the white space before it, and the white space at the end. The
units of a batch lie in one flat array beside the number of their text and their ordinal in it. Two cuts
per text give each unit its role; units are filtered by role, rebuilt into one list per text and joined.
No Python code runs per text or per unit.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import batches, ship

ship(__name__)

BATCH_BYTES = 1 << 22
# The contract's unit and sentinels, and a byte that no UTF-8 text holds.
UNIT = rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARK = b"\xff"


def draws(key: Column, seed: int) -> Column:
    """The first four 8-digit groups of the SHA-256 of ``seed:key`` as an array of longs.

    A null key is drawn like an empty one.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)])


def _modulo(value: pa.Array, by: pa.Array) -> pa.Array:
    return pc.subtract(value, pc.multiply(pc.divide(value, by), by))


def units(texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """Of a batch of texts (binary): units per text, and of each unit the bytes, the text and the ordinal."""
    marked = pc.replace_substring_regex(texts, pattern=UNIT, replacement=rb"\0" + MARK)
    lists = pc.split_pattern(marked, pattern=MARK)
    # Every unit is followed by a mark, so each list ends in an empty piece that is no unit.
    counts = pc.subtract(pc.list_value_length(lists).cast(pa.int64()), 1)
    parents = pc.list_parent_indices(lists)
    firsts = pc.subtract(pc.cumulative_sum(pc.add(counts, 1)), pc.add(counts, 1))
    flat = pc.list_flatten(lists)
    ordinals = pc.subtract(_counting(len(flat)), pc.take(firsts, parents))
    real = pc.less(ordinals, pc.take(counts, parents))
    return counts, pc.filter(flat, real), pc.filter(parents, real), pc.filter(ordinals, real)


def _counting(n: int) -> pa.Array:
    """0 to ``n - 1``."""
    return pc.subtract(pc.cumulative_sum(pa.repeat(pa.scalar(1, pa.int64()), n)), 1)


def joined_units(flat: pa.Array, mask: pa.Array, counts: pa.Array) -> pa.Array:
    """One string per text of its units under ``mask``, of which text ``i`` has ``counts[i]``."""
    ends = pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(counts)])
    lists = pa.LargeListArray.from_arrays(ends, pc.filter(flat, mask))
    return pc.binary_join(lists, pa.scalar(b"", pa.large_binary()))


def infilled_batch(texts: pa.Array, drawn: list[pa.Array], rate: int, spm_rate: int) -> list[pa.Array]:
    """Units, form, output, and code points of prefix and middle of every text; ``drawn`` has four longs each.

    ``rate`` in a hundred are transformed, and ``spm_rate`` in a hundred of these have the suffix first.
    """
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    has_sentinel = pc.or_(pc.or_(*(pc.match_substring(texts, s) for s in (PREFIX, SUFFIX))), pc.match_substring(texts, MIDDLE))
    hundred = pa.repeat(pa.scalar(100, pa.int64()), len(texts))
    late = pc.greater_equal(_modulo(drawn[2], hundred), rate)
    plain = pc.or_(pc.or_(pc.equal(pc.binary_length(texts), 0), has_sentinel), late)
    spm = pc.less(_modulo(drawn[3], hundred), spm_rate)
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))

    counts, flat, parents, ordinals = units(texts)
    places = [_modulo(d, pc.add(counts, 1)) for d in drawn[:2]]
    # Ordinals below the first cut are prefix, below the second middle; a plain text is all suffix.
    low = pc.if_else(plain, 0, pc.min_element_wise(*places))
    high = pc.if_else(plain, 0, pc.max_element_wise(*places))
    below_low, below_high = (pc.less(ordinals, pc.take(cut, parents)) for cut in (low, high))
    prefix = joined_units(flat, below_low, low)
    middle = joined_units(flat, pc.and_not(below_high, below_low), pc.subtract(high, low))
    suffix = joined_units(flat, pc.invert(below_high), pc.subtract(counts, high))

    p, s, m, nothing = (pa.scalar(x.encode(), pa.large_binary()) for x in (PREFIX, SUFFIX, MIDDLE, ""))
    psm_output = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, nothing)
    spm_output = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, nothing)
    output = pc.if_else(plain, texts, pc.if_else(spm, spm_output, psm_output))
    unknown = pa.scalar(None, pa.int64())
    sizes = [pc.if_else(plain, unknown, pc.utf8_length(x.cast(pa.large_string())).cast(pa.int64())) for x in (prefix, middle)]
    return [counts, form, output.cast(pa.string()), *sizes]


def infilled(docs: DataFrame, key: str, text: str, seed: int = 42, rate: int = 50, spm_rate: int = 80) -> DataFrame:
    """``key``, ``n`` units, ``form``, ``output``, ``prefix_chars`` and ``middle_chars`` of every row.

    The form is ``psm`` (prefix, suffix, middle), ``spm`` (suffix, prefix, middle) or ``plain``, the text
    as it is: for a share of the rows, for an empty text and for one that holds a sentinel. A null text
    counts as empty; a null key is drawn like an empty one. Bytes that are no UTF-8 count as U+FFFD. A
    row depends on itself alone, so repeated rows give equal rows; a text of any length is cut whole, in a
    batch of its own if it is long. Other columns are left out; an empty table gives no rows.
    """

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables:
            table = pa.Table.from_batches([batch])
            for a, b in batches(table, BATCH_BYTES, "text"):
                some = table.slice(a, b - a).combine_chunks().to_batches()[0]
                drawn = [some.column(f"h{i}") for i in range(4)]
                columns = [some.column("key"), *infilled_batch(some.column("text"), drawn, rate, spm_rate)]
                yield pa.RecordBatch.from_arrays(columns, names=[key, "n", "form", "output", "prefix_chars", "middle_chars"])

    rows = docs.select(F.col(key).alias("key"), F.make_valid_utf8(F.col(text)).alias("text"), draws(F.col(key), seed).alias("h"))
    rows = rows.select("key", "text", *[F.col("h")[i].alias(f"h{i}") for i in range(4)])
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, n long, form string, output string, prefix_chars long, middle_chars long")


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from; each sentinel occurs once in a transformed output."""
    rest = F.substring(output, len(PREFIX) + 1, 2**31 - 1)
    head, middle = F.substring_index(rest, MIDDLE, 1), F.substring_index(rest, MIDDLE, -1)
    psm = F.concat(F.substring_index(head, SUFFIX, 1), middle, F.substring_index(head, SUFFIX, -1))
    spm = F.concat(F.substring_index(head, PREFIX, -1), middle, F.substring_index(head, PREFIX, 1))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
