"""Lines that many documents share are kept in one document only. DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.tables import WHITE, lower_ascii, staged, text_or_empty, whole_row


def _lines(text: str) -> Column:
    return F.split(text_or_empty(text), "\n", -1)


def _key(line: Column, min_chars: int) -> Column:
    """96 bits of the digest of the normalised line; null for lines below the length."""
    plain = F.btrim(line, F.lit(WHITE))
    return F.when(
        (F.char_length(line) >= min_chars) & (F.char_length(plain) >= min_chars),
        F.substring(F.md5(lower_ascii(plain)), 1, 24),
    )


def drop_common_lines(
    docs: DataFrame, id: str = "doc_id", text: str = "text", min_chars: int = 40, min_docs: int = 5
) -> DataFrame:
    """The documents without lines that at least ``min_docs`` of them share.

    A line's key is the line stripped of ASCII white space at both ends, A-Z lower-cased. A key
    of at least ``min_chars`` code points found in ``min_docs`` rows or more stays only in the
    rows with the largest id that holds it, and there at all its places. Lines are cut at ``\\n``
    and joined by it again.

    Columns: those of the input with ``text`` replaced, then ``n_lines`` and ``n_dropped`` (long;
    input columns of these names are replaced). A null or empty text is one empty line. A null id
    is smaller than any other. Rows that repeat an id count as documents of their own, and rows
    of the largest id all keep the line. An empty table gives an empty table.

    Counting: keys are made distinct inside each row, exploded and pre-aggregated before the one
    shuffle, so a line of a third of all documents costs one row per task. The frequent keys are
    written out, so that the join that finds the positions to drop is of two plain inputs, which the
    engine can split where one key is hot. Positions return to the texts as a mask per document, so
    rebuilding is linear in its lines.
    """
    row = [F.col(id).alias("_id"), F.xxhash64(text_or_empty(text)).alias("_text_hash")]
    keys = F.transform(_lines(text), lambda line: _key(line, min_chars))
    counted = (
        docs.select(F.col(id).alias("_id"), F.explode(F.array_distinct(keys)).alias("_key"))
        .where(F.col("_key").isNotNull())
        .groupBy("_key")
        .agg(F.count(F.lit(1)).alias("_docs"), F.max("_id").alias("_last"))
        .where((F.col("_docs") >= min_docs) & F.col("_last").isNotNull())
        .select("_key", "_last")
    )
    counted = staged(counted)
    places = docs.select(*row, F.posexplode(keys).alias("_pos", "_key")).where(F.col("_key").isNotNull())
    drops = (
        places.join(counted, "_key")
        .where(F.col("_id").isNull() | (F.col("_id") < F.col("_last")))
        .groupBy("_id", "_text_hash")
        .agg(F.array_sort(F.collect_set("_pos")).alias("_drops"))
        .select("_id", "_text_hash", F.size("_drops").cast("long").alias("_n_dropped"), _mask("_drops").alias("_mask"))
    )
    rows = docs.select(whole_row(docs), F.col(id).alias("_row_id"), F.col(text).alias("_text"))
    rows = rows.withColumn("_row_hash", F.xxhash64(text_or_empty("_text")))
    same = rows["_row_id"].eqNullSafe(drops["_id"]) & (rows["_row_hash"] == drops["_text_hash"])
    kept = F.filter(_lines("_text"), lambda line, i: ~F.coalesce(F.get(F.col("_mask"), i), F.lit(False)))
    counts = {
        "n_lines": F.size(_lines("_text")).cast("long"),
        "n_dropped": F.coalesce(F.col("_n_dropped"), F.lit(0).cast("long")),
    }
    rest = [
        (F.array_join(kept, "\n") if c == text else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns if c not in counts
    ]
    return rows.join(drops, same, "left").select(*rest, *[c.alias(n) for n, c in counts.items()])


def _mask(positions: str) -> Column:
    """From ascending positions: an array that is true at them, as long as the last."""
    places = F.col(positions)
    return F.flatten(
        F.transform(
            places,
            lambda p, i: F.concat(
                F.array_repeat(F.lit(False), p - F.coalesce(F.get(places, i - 1), F.lit(-1)) - 1),
                F.array(F.lit(True)),
            ),
        )
    )
