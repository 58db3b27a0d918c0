"""Lines that a site repeats on many of its pages.

For each host, the pages that contain a line are divided by the host's pages; lines over a ratio are
boilerplate and dropped from every page of the host. Only DataFrame functions are used. A share rises
with the host, and a long passage does not recur by chance on any number of pages, so lines of some length
can be held to the least number of pages alone.

A line is named by two 64-bit hashes, so its text is not shuffled. Counting is by (host, line) with
partial sums, which spreads a host with very many pages. What comes back to the pages is one row per
host: a host whose pages have L different lines on average has fewer than L / ratio boilerplate
lines, so the row stays small however many pages there are, and the join may split a large host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.tables import staged

#: Share of a host's pages above which a line is boilerplate.
RATIO = 0.1
#: A line on fewer pages is never boilerplate, whatever its share of a small host.
LEAST_PAGES = 3
#: Words of a line, between white space, that make it a passage (for callers that ask for `long_words`).
PASSAGE_WORDS = 50

SKIPPED_HTML = r"(?is)<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>|<!--.*?-->"
BLOCK_TAGS = (
    r"(?i)</?(?:p|div|br|hr|li|ul|ol|nav|h[1-6]|table|tr|td|th|article|section|header|footer|title|body|head|html)"
    r"\b[^>]*>"
)
OTHER_TAGS = r"<[^>]*>"


def html_lines(html: Column) -> Column:
    """Text of a page with a line break for each block tag; scripts, styles, comments and tags go."""
    shown = F.regexp_replace(html, SKIPPED_HTML, " ")
    return F.regexp_replace(F.regexp_replace(shown, BLOCK_TAGS, "\n"), OTHER_TAGS, "")


def url_host(url: Column) -> Column:
    """The authority of a URL in lower case, null if there is none."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def drop_boilerplate(
    docs: DataFrame,
    host: Column,
    text_column: str = "text",
    ratio: float = RATIO,
    least_pages: int = LEAST_PAGES,
    counts: bool = False,
    long_words: int | None = None,
) -> DataFrame:
    """`docs` without the boilerplate lines of each row's host.

    Lines are compared after spaces at either end are cut; a page that repeats a line counts once.
    Blank lines are neither counted nor dropped, null texts stay null, a null host is a host of its
    own, and a text of boilerplate only becomes empty. Kept lines stay as they were. Repeated rows
    count as pages of their own. With `counts`, columns `n_lines` (lines that are not blank) and
    `n_dropped` are added, and replace such columns of `docs`.

    With `long_words`, a line of at least so many words is boilerplate on `least_pages` pages of a host
    whatever their share. For this rule, pages of equal text are one page: a passage that only copies of a
    whole page have in common is left to a search for copies, which keeps one.
    """
    rows = docs.select(
        F.struct(*[F.col(_quoted(c)) for c in docs.columns]).alias("row"),
        F.coalesce(host, F.lit("")).alias("host"),
        F.split(F.col(_quoted(text_column)), "\n").alias("lines"),
    )
    names = F.transform("lines", lambda line: F.trim(line))
    pages = rows.groupBy("host").agg(F.count("*").alias("pages"))
    seen = rows.select("host", F.explode(F.array_distinct(names)).alias("line"))
    if long_words is not None:
        rows = rows.withColumn("of", _name(F.array_join("lines", "\n")))
        # The text is named for long lines only, so that others are summed up as without the rule.
        is_long = F.size(F.filter(F.split("line", r"\s+"), lambda w: w != "")) >= long_words
        seen = rows.select("host", "of", F.explode(F.array_distinct(names)).alias("line")).withColumn(
            "of", F.when(is_long, F.col("of"))
        )
    seen = seen.filter("line <> ''").withColumn("name", _name(F.col("line"))).drop("line")
    common = seen.groupBy("host", "name").agg(F.count("*").alias("n"))
    if long_words is not None:
        of_text = seen.groupBy("host", "name", "of").agg(F.count("*").alias("n"))
        common = of_text.groupBy("host", "name").agg(F.sum("n").alias("n"), F.count("of").alias("texts"))
    common = common.filter(F.col("n") >= least_pages)
    if long_words is not None:
        common = staged(common, "repeated-lines")
    boilerplate = staged(
        common.join(pages, "host")
        .filter(F.col("n") > ratio * F.col("pages"))
        .groupBy("host")
        .agg(F.collect_list("name").alias("boilerplate")),
        "boilerplate",
    )
    told = rows.join(boilerplate, "host", "left")
    goes = lambda line: F.coalesce(F.array_contains("boilerplate", _name(F.trim(line))), F.lit(False))
    if long_words is None:
        some = F.col("boilerplate").isNotNull()
        dropped = goes
    else:
        # Passages may be many, so a page is told only its own; pages of equal text have equal ones.
        passages = common.filter(F.col("texts") >= least_pages).select("host", "name")
        own = seen.filter("of is not null").join(passages, ["host", "name"])
        own = own.groupBy("host", "of").agg(F.collect_set("name").alias("passages"))
        told = told.join(own, ["host", "of"], "left")
        some = F.col("boilerplate").isNotNull() | F.col("passages").isNotNull()
        dropped = lambda line: goes(line) | F.coalesce(
            F.array_contains("passages", _name(F.trim(line))), F.lit(False)
        )
    kept = F.when(some, F.filter("lines", lambda line: ~dropped(line))).otherwise(F.col("lines"))
    shown = F.size(F.filter("lines", lambda line: F.trim(line) != ""))
    none = F.col("lines").isNull()
    done = told.select(
        "row",
        F.array_join(kept, "\n").alias("kept_text"),
        F.when(none, 0).otherwise(shown).cast("long").alias("n_lines"),
        F.when(none, 0).otherwise(F.size("lines") - F.size(kept)).cast("long").alias("n_dropped"),
    )
    added = ["n_lines", "n_dropped"] if counts else []
    columns = [
        F.col("kept_text").alias(c) if c == text_column else F.col("row")[c].alias(c) for c in docs.columns if c not in added
    ]
    return done.select(*columns, *added)


def _name(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit("line"), line).alias("b"))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
