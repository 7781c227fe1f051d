"""Main text by consensus host paths.

Every page's containers are scored; the path of the best one is the page's vote.  Votes are added up per host
in Spark, and every page is extracted again under its host's winning paths, most votes first.  A page that holds
next to nothing there (under a fifth of what its own best container holds) is extracted under that container, and
a page without containers whole.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import qcol
from ..session import cut_lineage
from .common import rows_of, table, utf8
from .html_blocks import best_path, chosen_text, parse


def host_of(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def host_votes(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path, votes, score) over all pages."""
    arrow = pa.schema([("host", pa.string()), ("path", pa.string()), ("score", pa.float64())])

    def run(batches):
        for b in batches:
            got = ((host, best_path(parse(h.decode("utf-8", "replace")))) for host, h in rows_of(b))
            yield table([(host, *x) for host, x in got if x], arrow)

    src = pages.select(host_of(qcol(url_col)).alias("host"), utf8(html_col).alias("h"))
    votes = src.mapInArrow(run, "host string, path string, score double")
    return votes.groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum("score").alias("score"))


def winning_paths(votes: DataFrame, least_share: float = 0.1) -> DataFrame:
    """(host, paths): the paths with ``least_share`` or more of the host's votes (ten at most), most votes first, ties by score and name."""
    total = votes.groupBy("host").agg(F.sum("votes").alias("all"))
    # after the cut a host has 1 / least_share paths at most
    kept = votes.join(total, "host").where(F.col("votes") >= F.col("all") * F.lit(least_share))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("v"), (-F.col("score")).alias("s"), "path")))
    return kept.groupBy("host").agg(F.transform(ranked, lambda x: x["path"]).alias("paths"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", broadcast_hosts: int = 20_000,
              salts: int = 32) -> DataFrame:
    """page_id, url, text, n_chars per row of ``pages``.

    Null html gives an empty text; pages with a null or host-less url vote together.  Character references are
    decoded, white space inside a block is one space, blocks are joined in page order by a line feed.
    Repeated rows vote, and are returned, each for itself.  Other columns are ignored, whatever their names.
    """
    winners = cut_lineage(winning_paths(host_votes(pages, url_col, html_col)))
    src = pages.select(qcol(id_col).cast("long").alias("page_id"), qcol(url_col).cast("string").alias("url"),
                       host_of(qcol(url_col)).alias("host"), utf8(html_col).alias("h"))
    if winners.count() <= broadcast_hosts:              # of ten paths each at most
        rows = src.join(F.broadcast(winners), "host", "left")
    else:                                               # a host may have a third of all pages: salted
        spread = winners.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        rows = src.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int")).join(spread, ["host", "salt"], "left")
    arrow = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches):
        for b in batches:
            out = []
            for page, url, h, paths in rows_of(b):
                text = chosen_text(parse(h.decode("utf-8", "replace")), paths or [])
                out.append((page, url, text, len(text)))
            yield table(out, arrow)

    return rows.select("page_id", "url", "h", "paths").mapInArrow(run, "page_id long, url string, text string, n_chars long")
