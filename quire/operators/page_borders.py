"""T9 across page borders: words and sentences that a page break cut apart.

Whether something goes on over a border depends on the end of the last page
with any text and on the start of the next one. So only these few characters of
each page are sorted, in slices with halos (a book of very many pages is many
slices); the texts themselves stay rows and meet the outcome in one join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators.lines import repair_breaks
from quire.operators.scan import halo_lags
from quire.session import materialize


def repair_pages(pages: DataFrame, key: str = "book_id", page: str = "page_no", text: str = "text",
                 n_slices: int | None = None) -> DataFrame:
    """(key, page, glue, text): stripped pages, repaired inside like
    ``repair_breaks``, less a hyphen at their end that a small letter at the
    start of the next page resolves. ``glue`` stands before the page: nothing
    in the middle of such a word; a blank where the page before does not end a
    sentence and this one starts with a small letter; else a paragraph break;
    empty for a key's first page. ``concat(glue, text)`` in page order is the
    repaired text.

    Pages that are null or blank are left out and do not part what is around
    them. A null key is a key of its own. A repeated ``(key, page)`` has no
    defined neighbour: ValueError. No pages, no rows; other columns are left
    out."""
    rows = materialize(pages.select(F.col(key).alias("_key"), F.col(page).alias("_page"),
                                    T.py_strip(F.col(text)).alias("_text")).where("_text <> ''"))
    ends = rows.select("_key", "_page", F.substring("_text", 1, 1).alias("_head"), F.right("_text", F.lit(2)).alias("_tail"))
    near = materialize(halo_lags(ends, "_key", ["_page"], ["_tail", "_page"], [1], n_slices))
    if not near.where("_page = _page_lag1").isEmpty():
        raise ValueError(f"a page number occurs twice under one {key}")
    small = F.col("_head").rlike(r"^\p{Ll}")
    word = small & F.col("_tail_lag1").rlike(r"^\p{L}-\z")
    going = small & ~F.col("_tail_lag1").rlike(r"[.!?:]\z")
    near = near.withColumn("_word", F.coalesce(word, F.lit(False)))
    glue = F.when(F.col("_tail_lag1").isNull() | F.col("_word"), "").when(going, " ").otherwise("\n\n")
    # A word that goes on is news for two pages: the one before loses its hyphen.
    news = near.select("_key", "_page", glue.alias("_glue"), F.lit(0).alias("_cut")).unionByName(
        near.where("_word").select("_key", F.col("_page_lag1").alias("_page"), F.lit(None).cast("string").alias("_glue"),
                                   F.lit(1).alias("_cut")))
    news = news.groupBy("_key", "_page").agg(F.max("_glue").alias("_glue"), F.max("_cut").alias("_cut")).alias("n")
    r = rows.alias("r")
    both = r.join(news, F.col("r._key").eqNullSafe(F.col("n._key")) & F.col("r._page").eqNullSafe(F.col("n._page")))
    whole = F.expr("if(_cut = 1, left(_text, length(_text) - 1), _text)")
    return both.select(F.col("r._key").alias(key), F.col("r._page").alias(page), F.col("_glue").alias("glue"),
                       whole.alias("_text")).select(key, page, "glue", repair_breaks(F.col("_text")).alias("text"))
