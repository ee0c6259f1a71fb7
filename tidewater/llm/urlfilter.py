"""URL verdicts by host rules and a path-template tree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import ascii_lower, stored

#: (verdict, host, path prefix)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return (ascii_lower(F.regexp_extract(rest, "^([^/?#]*)", 1)),
            F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule (host and path written together) and its verdict; null where none fits.

    A rule fits its host and all subdomains where the path starts with the
    rule's.  Of rules of one length the first by code point wins.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    name = verdict = None
    for kind, rule_host, prefix in ordered:
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(prefix)
        name = F.when(fits, rule_host + prefix) if name is None else name.when(fits, rule_host + prefix)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, verdict)


def segments(path: Column, depth: int | None) -> Column:
    """Path segments with hexadecimal and decimal runs made wildcards; those past ``depth``, if given, are one ``**``."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    parts = F.transform(parts, lambda s: F.regexp_replace(
        F.regexp_replace(s, "(?<![0-9A-Za-z])(?=[0-9a-fA-F]*[0-9])[0-9a-fA-F]{8,}(?![0-9A-Za-z])", "<n>"),
        "[0-9]+", "<n>"))
    return parts if depth is None else F.when(F.size(parts) <= depth, parts).otherwise(
        F.concat(F.slice(parts, 1, depth), F.array(F.lit("**"))))


#: Smoothed bad rates are told apart in this many bands before alike branches are merged.
BANDS = 16


def _wild(segs: Column) -> Column:
    """Segments as wildcards; a lexical one stays visible, the names around it go."""
    return F.concat_ws("", F.transform(segs, lambda s: F.when(s.contains("<n>"), "/<n>").otherwise("/*")))


def _common(lo: Column, hi: Column) -> Column:
    """Number of first segments that two paths share."""
    same = F.zip_with(lo, hi, lambda a, b: a.eqNullSafe(b))
    apart = F.array_position(same, F.lit(False))
    return F.when(apart > 0, apart - 1).otherwise(F.size(same)).cast("int")


def _merged_bands(z: float) -> Column:
    """Group number of each of a node's ``bands`` (side, band, rated, bad): neighbours that are alike share one.

    Groups grow from the cleanest band on, on either side of the node's rate; a
    band joins the last group unless the two bad rates differ by more than
    ``z`` standard errors.
    """
    kind = "struct<side:boolean,rated:double,bad:double,grp:int,out:array<struct<side:boolean,band:int,grp:int>>>"
    start = F.expr(f"cast(named_struct('side', null, 'rated', 0, 'bad', 0, 'grp', 0, 'out', array()) as {kind})")

    def step(acc: Column, x: Column) -> Column:
        rated, bad = acc.rated + x.rated, acc.bad + x.bad
        q = (bad + 1) / (rated + 2)
        alike = (acc.side.eqNullSafe(x.side)
                 & (F.abs(x.bad / x.rated - F.try_divide(acc.bad, acc.rated))
                    <= z * F.sqrt(q * (1 - q) * (1 / x.rated + F.try_divide(F.lit(1.0), acc.rated)))))
        grp = F.when(alike, acc.grp).otherwise(acc.grp + 1)
        return F.struct(x.side.alias("side"), F.when(alike, rated).otherwise(x.rated).cast("double").alias("rated"),
                        F.when(alike, bad).otherwise(x.bad).cast("double").alias("bad"), grp.alias("grp"),
                        F.concat(acc.out, F.array(F.struct(x.side.alias("side"), x.band.alias("band"), grp.alias("grp"))))
                        .alias("out"))

    return F.aggregate(F.array_sort("bands"), start, lambda acc, x: step(acc, x).cast(kind), lambda acc: acc.out)


def _branch_names(tree: DataFrame, min_count: int, z: float) -> DataFrame:
    """``(host, template, seg, own)`` of the branches that do not become wildcards."""
    branch = (tree.groupBy("host", "template", F.get("rest", F.lit(0)).alias("seg"))
              .agg(F.sum("n").alias("n"), F.sum("rated").alias("rated"), F.sum("bad").alias("bad")))
    node = branch.groupBy("host", "template").agg(F.sum("rated").alias("all_rated"), F.sum("bad").alias("all_bad"))
    p = (F.col("all_bad") + 1) / (F.col("all_rated") + 2)
    off = F.col("bad") - F.col("rated") * p
    apart = F.abs(off) > z * F.sqrt(F.col("rated") * p * (1 - p) + 1)
    band = F.floor(F.lit(BANDS) * (F.col("bad") + 1) / (F.col("rated") + 2)).cast("int")
    own = stored(branch.join(node, ["host", "template"]).where((F.col("n") >= min_count) & (F.col("rated") > 0) & apart)
                 .select("host", "template", "seg", (off > 0).alias("side"), band.alias("band"), "rated", "bad"), "url-own")
    bands = (own.groupBy("host", "template", "side", "band").agg(F.sum("rated").alias("rated"), F.sum("bad").alias("bad"))
             .groupBy("host", "template").agg(F.collect_list(F.struct("side", "band", "rated", "bad")).alias("bands"))
             .select("host", "template", F.inline(_merged_bands(z))))  # at most 2 * BANDS entries a node
    keys = ["host", "template", "side", "band"]
    grouped = own.join(bands, keys).select("host", "template", "seg", "grp")
    names = grouped.groupBy("host", "template", "grp").agg(F.min("seg").alias("first"), F.count("seg").alias("members"))
    plain = (F.col("members") == 1) & ~F.col("first").isin("*", "<n>") & ~F.col("first").startswith("{")
    name = F.when(plain, F.col("first")).otherwise(
        F.concat(F.lit("{"), F.col("first"), F.lit("|+"), (F.col("members") - 1).cast("string"), F.lit("}")))
    return grouped.join(names.select("host", "template", "grp", name.alias("own")), ["host", "template", "grp"]).drop("grp")


def templates(shapes: DataFrame, min_count: int = 20, z: float = 1.96) -> DataFrame:
    """Generalise the tree of ``(host, segs, n, rated, bad)``: adds ``template``.

    Under each node a branch stands out if it is frequent (``min_count`` urls)
    and its labelled bad rate differs from that of all branches of the node
    together by more than ``z`` standard errors, however small its share of
    them; all others become ``*``.  Branches that stand out to the same side
    and are statistically alike merge with each other: ``{first|+k}`` is the
    first by code point and k more; one that is like no other keeps its name.
    A merged branch is one node below.  Wildcards that segments already hold
    do not count as names.

    A node of under ``min_count`` urls, or whose labels all agree, has no branch
    that stands out, nor has one with a single branch: whole paths below the
    former and the shared start of paths below the latter are settled in one
    step.  So rounds follow the nodes that really branch under mixed labels,
    not the depth of paths.  Branches are summed by (host, template, segment)
    before they meet; of a node only bands of rates come together in one row.
    """
    columns = shapes.columns + ["template"]
    tree = shapes.withColumn("template", F.lit("")).withColumn("rest", F.col("segs"))
    done = tree.where(F.size("rest") == 0).select(*columns)
    tree = tree.where(F.size("rest") > 0)
    while True:
        node = tree.groupBy("host", "template").agg(
            F.sum("n").alias("all_n"), F.sum("rated").alias("all_rated"), F.sum("bad").alias("all_bad"),
            F.min("rest").alias("lo"), F.max("rest").alias("hi"))
        mixed = (F.col("all_n") >= min_count) & (F.col("all_bad") > 0) & (F.col("all_bad") < F.col("all_rated"))
        node = node.select("host", "template", F.when(mixed, _common(F.col("lo"), F.col("hi"))).alias("shared"))
        skip = F.coalesce("shared", F.size("rest"))
        ahead = tree.join(node, ["host", "template"]).select(
            *shapes.columns, F.concat("template", _wild(F.slice("rest", F.lit(1), skip))).alias("template"),
            F.slice("rest", skip + 1, F.size("rest")).alias("rest"))
        ahead = stored(ahead, "url-tree")
        done = done.unionByName(ahead.where(F.size("rest") == 0).select(*columns))
        ahead = ahead.where(F.size("rest") > 0)
        if not ahead.limit(1).count():
            return done
        first = F.get("rest", F.lit(0))
        step = ahead.withColumn("seg", first).join(_branch_names(ahead, min_count, z), ["host", "template", "seg"], "left")
        part = F.coalesce(F.concat(F.lit("/"), F.col("own")), _wild(F.array(F.col("seg"))))
        tree = stored(step.select(*shapes.columns, F.concat("template", part).alias("template"),
                                  F.slice("rest", F.lit(2), F.size("rest")).alias("rest")), "url-tree")
        done = done.unionByName(tree.where(F.size("rest") == 0).select(*columns))
        tree = tree.where(F.size("rest") > 0)


def judge(pages: DataFrame, rated: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
          depth: int | None = None, prior: float = 5.0, cut: float = 0.5) -> DataFrame:
    """Verdict on every url: ``page_id, host, path, rule, verdict, template, purity, rated``.

    ``rated`` has ``page_id, bad`` (0 or 1) for labelled pages.  Where a rule
    fits, its verdict holds.  Elsewhere the url's template on its host does: its
    purity, the share of labelled pages that are not bad, is smoothed by
    ``prior`` pages at the host's purity, itself smoothed by the overall one;
    under ``cut`` the template is blocked.  The tree goes down to the deepest
    path; with ``depth``, branches below so many segments are not told apart.  Null urls and urls without ``://``
    have an empty host, path and template.  Pages without label count for
    frequency only; an id labelled twice is bad if one label says so, null ids
    and null labels do not count.  Repeated rows: each a row.  Empty table:
    empty.  Extra columns are not looked at.

    Urls are summed by host and lexical path before the tree is built, so a
    host with any share of the pages is one row per path shape; one row per
    shape joins back to the pages.
    """
    host, path = host_and_path(F.col("url"))
    marks = (rated.where(F.col("page_id").isNotNull() & F.col("bad").isNotNull())
             .groupBy(F.col("page_id").alias("_page")).agg(F.max("bad").alias("bad")))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    urls = urls.withColumn("segs", segments(F.col("path"), depth))
    known = urls.join(marks, F.col("page_id") == F.col("_page"), "left")
    shapes = stored(known.groupBy("host", "segs").agg(
        F.count(F.lit(1)).alias("n"), F.count("bad").alias("rated"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")), "url-shapes")
    tree = templates(shapes)
    overall = shapes.agg(((F.sum("rated") - F.sum("bad") + 1) / (F.sum("rated") + 2)).alias("p_all"))
    by_host = tree.groupBy("host").agg(F.sum("rated").alias("h_rated"), F.sum("bad").alias("h_bad"))
    by_template = (tree.groupBy("host", "template").agg(F.sum("rated").alias("t_rated"), F.sum("bad").alias("t_bad"))
                   .join(by_host, "host").crossJoin(F.broadcast(overall)))  # one row
    p_host = (F.col("h_rated") - F.col("h_bad") + prior * F.col("p_all")) / (F.col("h_rated") + prior)
    purity = (F.col("t_rated") - F.col("t_bad") + prior * p_host) / (F.col("t_rated") + prior)
    graded = by_template.select("host", "template", purity.alias("purity"), F.col("t_rated").alias("rated"))
    named = tree.select("host", "segs", "template").join(graded, ["host", "template"])
    out = urls.join(named, ["host", "segs"])
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("purity") < cut, "block").otherwise("allow")
    return out.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"),
                      "template", "purity", "rated")


def rated_by_document(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``page_id, bad`` of pages whose path names a labelled document by its first number."""
    _, path = host_and_path(F.col("url"))
    number = F.regexp_extract(path, "([0-9]+)", 1)
    named = pages.select("page_id", number.alias("number")).where(F.length("number").between(1, 18))
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNotNull(), 0)
    worst = labels.groupBy(F.col("doc_id").alias("_doc")).agg(F.max(bad).alias("bad"))
    return named.join(worst, F.col("number").cast("bigint") == F.col("_doc")).select("page_id", "bad")
