"""Line dedup by winnowing: later copies of runs of lines that stand earlier are deleted.

Everything is measured in words, a line without words counting as one. A gram is the shortest run
of whole lines from a line on with at least so many words. Of the short grams that start within a
window of words the one with the smallest hash is a fingerprint. A run of at least ``min_words``
words holds one whole window of short grams at its start, so two documents that share the run
share a fingerprint. Only documents with a shared fingerprint are looked at further: their long
grams (``min_words`` words), the shortest from a line on and the shortest up to a line, are joined
with the place where each stands first, and the lines of the later places go. Each line of a
repeated run lies in such a gram of the run, whichever earlier place the run has.

SQL functions only, no Python on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.llm.shared import all_columns, stored, unused, words_of

MIN_WORDS = 50


def document_key(doc_id: Column, text: Column) -> Column:
    """Names a document by id and text and sorts by id, NULL ids last."""
    return F.struct(
        doc_id.isNull().alias("no_id"), doc_id.alias("id"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_key"),
    )


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_table(documents: DataFrame, id_column: str, text_column: str, min_words: int) -> DataFrame:
    """``doc, line, long_hash, long_size, back_hash, back_size, chosen``, one row per line of each
    distinct document.

    ``long_hash`` names the long gram from the line on, of ``long_size`` lines, ``back_hash`` the
    one up to the line, of ``back_size``; NULL if there is no whole one. ``chosen`` is the
    fingerprint (hash, line) of the window that starts at the line.
    """
    short = min_words // 2
    window = min_words - short + 1
    lines = documents.select(
        document_key(F.col(id_column), F.col(text_column)).alias("doc"),
        F.posexplode(lines_of(F.col(text_column))).alias("line", "content"),
    ).select(
        "doc", "line", F.xxhash64("content").alias("hash"),
        F.greatest(words_of(F.col("content")), F.lit(1)).alias("words"),
    ).distinct()
    in_order = Window.partitionBy("doc").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    placed = lines.withColumn(
        "at", F.coalesce(F.sum("words").over(in_order), F.lit(0)).cast("long")
    ).withColumn("through", F.col("at") + F.col("words"))
    by_words = Window.partitionBy("doc").orderBy("at")
    short_gram = by_words.rangeBetween(0, short - 1)
    long_gram = by_words.rangeBetween(0, min_words - 1)
    back_gram = Window.partitionBy("doc").orderBy("through").rangeBetween(1 - min_words, 0)
    grams = placed.select(
        "doc", "line", "at",
        F.when(
            F.sum("words").over(short_gram) >= short,
            F.xxhash64(F.collect_list("hash").over(short_gram)),
        ).alias("short_hash"),
        F.collect_list("hash").over(long_gram).alias("long_lines"),
        (F.sum("words").over(long_gram) >= min_words).alias("is_long"),
        F.collect_list("hash").over(back_gram).alias("back_lines"),
        (F.sum("words").over(back_gram) >= min_words).alias("is_back"),
    )
    candidate = F.when(F.col("short_hash").isNotNull(), F.struct("short_hash", "line"))
    return grams.select(
        "doc", "line",
        F.when(F.col("is_long"), F.xxhash64("long_lines")).alias("long_hash"),
        F.size("long_lines").alias("long_size"),
        F.when(F.col("is_back"), F.xxhash64("back_lines")).alias("back_hash"),
        F.size("back_lines").alias("back_size"),
        F.min(candidate).over(by_words.rangeBetween(0, window - 1)).alias("chosen"),
    )


def shared_fingerprints(lines: DataFrame) -> DataFrame:
    """``doc``: the documents that hold a fingerprint which stands at more than one place."""
    prints = lines.where("chosen IS NOT NULL").select(
        "doc", F.col("chosen.line").alias("line"), F.col("chosen.short_hash").alias("print")
    ).distinct()
    often = stored(
        prints.groupBy("print").count().where("count > 1").select("print"), "lines-often"
    )
    return prints.join(often, "print", "left_semi").select("doc").distinct()


def repeated_lines(lines: DataFrame) -> DataFrame:
    """``doc, gone``: the sorted numbers of the lines that repeat an earlier run."""
    found = lines.join(shared_fingerprints(lines), "doc", "left_semi")
    # The shortest runs from a line on cover a run but for its end, those up to a line its end.
    grams = stored(
        found.where("long_hash IS NOT NULL").select(
            "doc", "line", F.col("long_hash").alias("gram"), F.col("long_size").alias("length")
        ).union(found.where("back_hash IS NOT NULL").select(
            "doc", F.col("line") - F.col("back_size") + 1, "back_hash", "back_size"
        )),
        "lines-shared",
    )
    # Written, so that the join's both sides are plain scans and a hot gram's partition is split.
    firsts = stored(
        grams.groupBy("gram").agg(
            F.min(F.struct("doc", "line")).alias("first"),
            F.max(F.struct("doc", "line")).alias("last"),
        ).where("first <> last").select("gram", "first"),
        "lines-first",
    )
    return grams.join(firsts, "gram").where(F.struct("doc", "line") != F.col("first")).select(
        "doc", F.explode(F.sequence("line", F.col("line") + F.col("length") - 1)).alias("line")
    ).distinct().groupBy("doc").agg(F.array_sort(F.collect_list("line")).alias("gone"))


def dedup_lines(
    documents: DataFrame, min_words: int = MIN_WORDS, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``documents`` without the lines that repeat an earlier run, and ``removed_lines``.

    Rows and other columns stay as they are; ``removed_lines`` holds the numbers, from 0, of the
    lines that went. Earlier means a smaller id (NULL ids last), then an earlier line. A run is
    several lines or one, equal to the letter, of at least ``min_words`` words. Rows equal in id
    and text are one document and lose the same lines; a NULL text stays NULL; an empty text has
    nothing to lose; a document that only repeats others becomes empty. Long texts are read whole.
    Where ``documents`` has a column ``removed_lines`` it stays, and the new one ends in ``_``.
    """
    lines = stored(line_table(documents, id_column, text_column, min_words), "lines")
    gone = repeated_lines(lines)
    split = lines_of(F.col("_row")[text_column])
    kept = F.array_except(
        F.sequence(F.lit(0), F.size(split) - 1), F.col("gone")
    )
    text = F.when(F.col("gone").isNull(), F.col("_row")[text_column]).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(split, i)), "\n")
    )
    rows = documents.select(
        F.struct(*all_columns(documents)).alias("_row"),
        document_key(F.col(id_column), F.col(text_column)).alias("doc"),
    )
    others = [
        (text if c == text_column else F.col("_row")[c]).alias(c) for c in documents.columns
    ]
    return rows.join(gone, "doc", "left").select(
        *others,
        F.coalesce("gone", F.array().cast("array<int>")).alias(unused(documents, "removed_lines")),
    )
