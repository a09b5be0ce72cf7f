"""URL filter: given host and path rules, and templates learned from the labels those rules give."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.work import Scratch, lower_ascii, with_columns_last


@dataclass(frozen=True)
class Rule:
    """Applies to ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules in use.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)
# Segments below this depth stay together as one tail of the template.
DEPTH = 6
# A node whose children are this many or more, each seen this rarely on average, has a variable child.
FANOUT, RARE = 8, 3.0
# Pages a parent's block share is worth in its child, and the share of blocked pages that rejects.
PRIOR, REJECT = 4.0, 0.5
# A branch merges into its parent unless their block shares differ at this chi-square (5 % level).
CHI2 = 3.84
# Segments that are identifiers by their looks, before any counting: digits or long hexadecimal
# numbers, with or without a file ending, which is kept.
NUMERIC = r"^(?:[0-9]+|[0-9A-Fa-f]{8,}|[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12})(\.[A-Za-z0-9]{1,5})?$"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and where ``://`` is missing."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)
    return lower_ascii(host), path


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):  # later ones override
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def segments(path: Column) -> Column:
    """Path segments down to ``DEPTH``, identifiers as ``{id}``; deeper ones joined in one tail."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    looked = F.transform(parts, lambda s: F.regexp_replace(s, NUMERIC, r"{id}$1"))
    head = F.slice(looked, 1, DEPTH)
    return F.when(F.size(looked) <= DEPTH, head).otherwise(F.concat(head, F.array(F.lit("{tail}"))))


def learn_templates(shapes: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Generalise ``shapes(host, segs, pages, bad)`` level by level.

    Returns the shapes with their ``template`` and the purity of every tree node (``host``, ``node``,
    ``purity``). Counts are summed before each shuffle, so a host with a third of all pages costs one
    row per distinct shape, and its nodes are dealt out by host and prefix, not by host alone.
    """
    shapes = scratch.keep(shapes.withColumn("template", F.lit("")))
    for level in range(1, DEPTH + 2):
        seg = F.get("segs", F.lit(level - 1))
        here = shapes.withColumn("seg", seg)
        children = here.filter("seg is not null").groupBy("host", "template", "seg").agg(F.sum("pages").alias("p"))
        fan = children.groupBy("host", "template").agg(
            F.count(F.lit(1)).alias("kinds"), F.sum("p").alias("p"), F.max("p").alias("top")
        )
        # Many children, each rare: the segment varies. A frequent child beside rare ones keeps its name.
        variable = fan.filter((F.col("kinds") >= FANOUT) & (F.col("p") - F.col("top") < F.lit(RARE) * (F.col("kinds") - 1)))
        named = children.filter(F.col("p") >= F.lit(RARE * FANOUT)).select("host", "template", "seg", F.lit(True).alias("named"))
        marked = here.join(variable.select("host", "template", F.lit(True).alias("varies")), ["host", "template"], "left").join(
            named, ["host", "template", "seg"], "left"
        )
        step = F.when(F.col("varies") & F.col("named").isNull() & ~F.col("seg").startswith("{"), "*").otherwise(F.col("seg"))
        shapes = scratch.keep(
            marked.select(
                "host",
                "segs",
                "pages",
                "bad",
                F.when(F.col("seg").isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/"), step)).alias("template"),
            )
        )
    return shapes, _purity(shapes, scratch)


def _purity(shapes: DataFrame, scratch: Scratch) -> DataFrame:
    """Share of pages labelled block in each node, smoothed by its parent's share, root to leaves.

    Pages without label count as not blocked: a rule against one branch must not reject its siblings.
    A node whose share does not differ significantly from its parent's is merged with it: it takes the
    parent's share, as do its like siblings.
    """
    depth = lambda c: F.size(F.split(c, "/")) - 1
    totals = shapes.agg(F.sum("pages").alias("n"), F.sum("bad").alias("b")).first()
    prior = (float(totals["b"] or 0) + 0.5) / (float(totals["n"] or 0) + 1.0)
    parts = F.split("template", "/")
    nodes = scratch.keep(
        shapes.select(
            "host",
            F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))).alias("node"),
            "pages",
            "bad",
        )
        .groupBy("host", "node")
        .agg(F.sum("pages").alias("pages"), F.sum("bad").alias("bad"))
        .withColumn("depth", depth(F.col("node")))
    )
    smooth = lambda up: (F.col("bad") + F.lit(PRIOR) * up) / (F.col("pages") + F.lit(PRIOR))
    level = nodes.filter("depth = 0").select("host", "node", smooth(F.lit(prior)).alias("purity"))
    done = [scratch.keep(level)]
    for d in range(1, DEPTH + 2):
        up = done[-1].select("host", F.col("node").alias("parent"), F.col("purity").alias("up"))
        n, expected = F.col("pages"), F.col("up")
        chi2 = F.pow(F.col("bad") - n * expected, F.lit(2.0)) / (n * expected * (F.lit(1.0) - expected))
        here = (
            nodes.filter(F.col("depth") == d)
            .withColumn("parent", F.substring_index("node", "/", d))
            .join(up, ["host", "parent"])
            .select("host", "node", F.when(chi2 > CHI2, smooth(F.col("up"))).otherwise(F.col("up")).alias("purity"))
        )
        done.append(scratch.keep(here))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Every page with ``host``, ``path``, ``rule``, ``verdict``, ``template`` and ``block_share``.

    Where a rule fits, its verdict stands. Pages with a rule are also the labelled examples: per host,
    paths become templates (identifier and variable segments as wildcards), templates whose share of
    blocked pages does not differ from their branch's merge with it, and a page without rule is blocked
    when its template's smoothed share exceeds one half.

    A url that is null or has no ``://`` has empty host and path: no rule fits, and it is judged with
    the other pages of the empty host. Repeated rows are repeated in the result; input columns named
    like the new ones give way. Only ``url`` is read for learning.
    """
    scratch = Scratch(pages.sparkSession)
    host, path = split_url(F.col("url"))

    def located(df: DataFrame) -> DataFrame:
        parts = with_columns_last(df, host=host, path=path)
        name, verdict = rule_for(F.col("host"), F.col("path"), rules)
        return with_columns_last(parts, rule=name, verdict=verdict, __segs=segments(F.col("path")))

    shapes = (
        located(pages.select("url"))
        .groupBy("host", F.col("__segs").alias("segs"))
        .agg(
            F.count(F.lit(1)).alias("pages"),
            F.sum(F.when(F.col("verdict") == "block", 1).otherwise(0)).alias("bad"),
        )
    )
    shapes, purity = learn_templates(shapes, scratch)
    learned = shapes.join(purity, (shapes["host"] == purity["host"]) & (shapes["template"] == purity["node"])).select(
        shapes["host"].alias("__host"), F.col("segs").alias("__s"), F.col("template").alias("__template"), F.col("purity").alias("__purity")
    )
    judged = located(pages).join(learned, (F.col("host") == F.col("__host")) & (F.col("__segs") == F.col("__s")), "left")
    method = F.when(F.col("__purity") > REJECT, "block").otherwise("allow")
    return with_columns_last(
        judged,
        verdict=F.coalesce("verdict", method),
        template=F.col("__template"),
        block_share=F.col("__purity"),
    ).drop("__host", "__s", "__template", "__purity", "__segs")
