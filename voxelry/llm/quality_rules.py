"""Quality rules with adaptive thresholds: no UDF, pandas or RDD; DataFrame functions only.

Every document gets the counts of ``counts``; ratios of these feed KLL quantile sketches per language and source. The sketches are
mergeable, so the sketch of a language, and of the whole corpus, is merged from those of its sources without another
look at the documents. A document is rejected if a ratio lies outside the fence of its group's quartiles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import staged
from .frame import OWN, narrow, refuse

WORD_GAP = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Items a sketch keeps exactly; its rank error beyond is about 0.3 %.
SKETCH_K = 1024
#: Ratio, whether a small value is suspicious too, and the distance from the quartiles that is always tolerated.
RATIOS: tuple[tuple[str, bool, float], ...] = (
    ("symbols_per_word", False, 0.1),
    ("mean_word_chars", True, 2.0),
    ("dup_line_share", False, 0.5),
    ("repeat_share", False, 0.35),
)


def _bound(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once however often ``body`` mentions it."""
    return F.get(F.transform(F.array(value), body), 0)


def _covered(words: Column) -> Column:
    """Words inside 3-word windows that occur at least twice: windows are hashed and sorted with their positions, so equal
    ones are neighbours; each repeated start then covers up to three words, less where the next start is nearer."""
    keys = F.transform(F.sequence(F.lit(0), F.size(words) - 3),
                       lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    pairs = F.sort_array(F.transform(keys, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeated = _bound(pairs, lambda p: F.filter(
        F.transform(p, lambda x, k: F.when((F.get(p, k - 1)["h"] == x["h"]) | (F.get(p, k + 1)["h"] == x["h"]), x["i"])),
        lambda i: i.isNotNull()))
    return _bound(F.sort_array(repeated), lambda p: F.aggregate(
        F.transform(p, lambda x, k: F.when(k == 0, F.lit(3)).otherwise(F.least(F.lit(3), x - F.get(p, k - 1)))),
        F.lit(0), lambda total, x: total + x))


def counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words (long) in place of the text.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text; null and empty texts have none. All work is inside a row, so long
    texts and hot groups move nothing.
    """
    text_col = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    words = F.filter(F.split(text_col, WORD_GAP), lambda w: w != "")
    lines = F.filter(F.split(text_col, "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\x0c\r", "")) > 0)

    def measured(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.when(F.size(w) >= 3, _covered(w)).otherwise(0).cast("long").alias("n_repeat_words"))

    def of_lines(x: Column) -> Column:
        return F.struct(F.size(x).cast("long").alias("n_lines"),
                        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))

    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    return docs.select(
        *rest, _bound(words, measured).alias(f"{OWN}w"), _bound(lines, of_lines).alias(f"{OWN}l"),
        (F.length(text_col) - F.length(F.translate(text_col, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    ).select(*rest, f"{OWN}w.*", f"{OWN}l.*", "n_symbols")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def ratios() -> dict[str, Column]:
    words, lines = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("n_lines"), F.lit(1))
    return {"symbols_per_word": F.col("n_symbols") / words, "mean_word_chars": F.col("word_chars") / words,
            "dup_line_share": F.col("n_dup_lines") / lines, "repeat_share": F.col("n_repeat_words") / words}


def sketches(measured: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """One KLL sketch a ratio for every (lang, source) of the documents that pass the base rules. A hot source is
    pre-aggregated in every task: what is shuffled is one sketch a group and task."""
    return (measured.filter(~base_failed()).groupBy("lang", "source")
            .agg(F.count("*").alias("n"), *[F.kll_sketch_agg_double(c.cast("double"), F.lit(k)).alias(n) for n, c in ratios().items()]))


def fences(per_group: DataFrame, min_docs: int = 200, reach: float = 3.0) -> DataFrame:
    """Bounds ``<ratio>_low`` and ``<ratio>_high`` of every (lang, source).

    A group of fewer than ``min_docs`` documents takes the merged sketch of its language, a language of fewer that of the corpus. The fence lies
    ``reach`` quartile distances beyond the quartiles, and at least the tolerance of ``RATIOS``.
    """
    names = [r[0] for r in RATIOS]
    merged = [F.kll_merge_agg_double(n).alias(n) for n in names]
    levels = []
    for by in (["lang", "source"], ["lang"], []):
        level = per_group if len(by) == 2 else per_group.groupBy(*by).agg(F.sum("n").alias("n"), *merged)
        quartiles = [F.kll_sketch_get_quantile_double(n, F.array(F.lit(0.25), F.lit(0.75))).alias(n) for n in names]
        levels.append(level.filter("n > 0").select(*by, F.struct("n", *quartiles).alias(f"q{len(by)}")))
    of_group, of_lang, of_all = levels
    chosen = (of_group.join(of_lang.withColumnRenamed("lang", "l1"), F.col("lang").eqNullSafe(F.col("l1")), "left")
              .join(F.broadcast(of_all), F.lit(True), "left")  # one row
              .select("lang", "source", F.when(F.col("q2.n") >= min_docs, F.col("q2")).when(F.col("q1.n") >= min_docs, F.col("q1"))
                      .otherwise(F.col("q0")).alias("q")))
    bounds = []
    for name, both, slack in RATIOS:
        low, high = F.get(F.col(f"q.{name}"), F.lit(0)), F.get(F.col(f"q.{name}"), F.lit(1))
        margin = F.greatest(reach * (high - low), F.lit(slack))
        bounds += [(low - margin if both else F.lit(float("-inf"))).alias(f"{name}_low"), (high + margin).alias(f"{name}_high")]
    return chosen.select("lang", "source", *bounds)


def quality_rules(docs: DataFrame, min_docs: int = 200, reach: float = 3.0, k: int = SKETCH_K) -> DataFrame:
    """A row a document: doc_id, lang, source, the counts, ``base_failed`` and ``kept``.

    ``docs`` has doc_id, text, lang and source; other columns are not read. Null and empty texts have no words and fail the base
    rules; null languages and sources are groups of their own; repeated rows are judged each; an empty table gives no rows.
    The narrow counts and the fences are written to the shared folder once, so that a lost executor cannot make two tasks
    see different fences (a KLL sketch beyond ``k`` items draws at random). Fences are joined on the group; the planner
    splits the partition of a hot group, as the counts' side of that join is a plain shuffle.
    """
    measured = staged(counts(narrow(docs, "doc_id", "text", "lang", "source")), "quality-counts")
    limits = staged(fences(staged(sketches(measured, k), "quality-sketches"), min_docs, reach), "quality-fences")
    limits = limits.withColumnsRenamed({"lang": f"{OWN}lang", "source": f"{OWN}source"})
    inside = F.lit(True)
    for name, column in ratios().items():
        inside = inside & F.coalesce(column.between(F.col(f"{name}_low"), F.col(f"{name}_high")), F.lit(True))
    same = F.col("lang").eqNullSafe(F.col(f"{OWN}lang")) & F.col("source").eqNullSafe(F.col(f"{OWN}source"))
    return measured.join(limits, same, "left").select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & inside).alias("kept"))


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns. Joined on the document's id: rows that share an id stay if one of them is kept;
    a null id cannot be joined and such a row is judged by the base rules alone."""
    refuse(docs)
    good = quality_rules(docs, **options).filter("kept").select(F.col("doc_id").alias(f"{OWN}id")).distinct()
    known = docs.join(good, F.col("doc_id") == F.col(f"{OWN}id"), "left_semi")
    nameless = docs.filter("doc_id IS NULL")
    passed = counts(nameless.withColumn(f"{OWN}t", F.col("text")), f"{OWN}t").filter(~base_failed()).select(*docs.columns)
    return known.unionByName(passed)
