"""Gates before a fetch: robots rules (J3). The status gate (F1) and the size
gate (F19) live with the response scan in ``crawlstats.sources.pages``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlstats.functions.urls import url_parts


def robots_gate(urls: DataFrame, rules: DataFrame, *, url_col: str = "url") -> DataFrame:
    """Add ``allowed``: the longest matching rule of the URL's host decides
    (allow on ties); a host without rules, or a URL no rule matches, is allowed.

    A rule matches the start of path and query (``/search?q=``); the empty
    path of a site's root, which normalised URLs have, is ``/``; a rule
    without a path, as an empty ``Disallow:`` line, matches nothing. Each
    distinct host and path is cut at the lengths that its host's rules have
    and the cuts meet the rules in a plain equi-join on (host, prefix), so no
    host's rules or URLs gather in one task, whatever their number.
    """
    p = url_parts(url_col)
    query = F.when(p["query"] != "", F.concat(F.lit("?"), p["query"])).otherwise("")
    keyed = urls.withColumn("_host", p["netloc"]).withColumn("_path", F.concat(F.when(p["path"] == "", F.lit("/")).otherwise(p["path"]), query))
    rules = rules.where("path_prefix <> ''").select(F.col("host").alias("_host"), F.col("path_prefix").alias("_prefix"), "allow")
    lengths = rules.select("_host", F.length("_prefix").alias("_len")).distinct()
    paths = keyed.select("_host", "_path").distinct()
    cuts = paths.join(lengths, "_host").where(F.length("_path") >= F.col("_len"))
    cuts = cuts.withColumn("_prefix", F.substring("_path", F.lit(1), F.col("_len")))
    hits = cuts.join(rules, ["_host", "_prefix"])
    verdict = hits.groupBy("_host", "_path").agg(F.max(F.struct("_len", "allow")).alias("_best"))
    same = (keyed["_host"] == verdict["_host"]) & (keyed["_path"] == verdict["_path"])
    joined = keyed.join(verdict, same, "left")
    return joined.select(*[keyed[c] for c in urls.columns], F.coalesce(F.col("_best.allow"), F.lit(True)).alias("allowed"))
