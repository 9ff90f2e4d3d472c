"""Mixing sources to target weights by hierarchical budgeting.

A tree of levels (here domain, language, source) shares a token budget from the root down. Siblings
share their parent's budget by weight; where a subtree cannot use its share, even when its texts
are repeated, the rest goes to its siblings first and only then is lost to the level above. Each
leaf takes whole epochs of its texts and, of the last epoch's seeded order, the longest prefix whose
tokens fit.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tellmark.llm.common import INK, documents, present
from tellmark.session import stored

LEVELS = ["domain", "lang", "source"]
WEIGHTS = {
    "domain": {"web": 5, "books": 3, "code": 2},
    "lang": {"en": 4, "fr": 2, "de": 2, "es": 1},
    "source": {"src0": 3},
}
#: Hexadecimal digits of the order key that are summed before rows are ranked.
DIGITS = 3


def domain_of(source: Column) -> Column:
    """The domain of a source, by a hash of its name: half web, a quarter each books and code."""
    digit = F.substring(F.md5(present(source)), 1, 1)
    return F.when(digit < "8", "web").when(digit < "c", "books").otherwise("code")


def token_count(text: Column) -> Column:
    return F.regexp_count(present(text), F.lit(INK)).cast("bigint")


def _weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    """The integer weight of a node by its name; 1 where none is given."""
    chosen = F.lit(1)
    for name, w in weights.get(level, {}).items():
        chosen = F.when(F.col(level) == name, w).otherwise(chosen)
    return chosen.cast("bigint")


def budgets(leaves: DataFrame, budget: Column, weights: dict[str, dict[str, int]], levels: list[str], epochs: int) -> DataFrame:
    """Leaves (levels, tokens) with the tokens granted to each.

    Among siblings sorted by tokens per weight, the water level is the largest of
    (budget - tokens of the smaller ones) / (weights from here on); a node gets its weight times the
    level, or all it has. Weights are whole numbers; a node of weight 0 gets nothing.
    """
    nodes = leaves.withColumn("cap", F.col("tokens") * epochs)
    for level in levels:
        nodes = nodes.withColumn(f"w_{level}", _weight(level, weights))
    nodes = nodes.withColumn("cap", F.when(F.least(*[F.col(f"w_{x}") for x in levels]) > 0, F.col("cap")).otherwise(0))
    granted = nodes.groupBy().agg(F.least(budget, F.sum("cap")).alias("granted"))
    for depth, level in enumerate(levels):
        path = levels[: depth + 1]
        here = nodes.groupBy(*path, f"w_{level}").agg(F.sum("cap").alias("cap")).filter(F.col(f"w_{level}") > 0)
        parent = path[:-1]
        here = here.join(granted, parent) if parent else here.crossJoin(granted)  # one row
        order = W.partitionBy(*parent).orderBy(F.col("cap") / F.col(f"w_{level}"), level)
        before = F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        after = F.sum(f"w_{level}").over(order.rowsBetween(0, W.unboundedFollowing))
        here = here.withColumn("water", (F.col("granted") - before).cast("double") / after.cast("double"))
        here = here.withColumn("water", F.max("water").over(W.partitionBy(*parent)))
        granted = here.select(*path, F.least(F.col("cap"), F.floor(F.col(f"w_{level}") * F.col("water"))).cast("bigint").alias("granted"))
    return leaves.join(granted, levels, "left").withColumn("granted", F.greatest(F.coalesce("granted", F.lit(0)), F.lit(0)))


def order_key(seed: int, epoch: Column, id_: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), F.coalesce(id_.cast("string"), F.lit(""))))


def mix(
    docs: DataFrame, domain: Column, weights: dict[str, dict[str, int]] = WEIGHTS, percent: int = 50, epochs: int = 3,
    seed: int = 5, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
) -> DataFrame:
    """Each selected row once for each epoch that selects it, with `mix`, a struct of domain, lang,
    source, tokens and epoch; a column `mix` of the input is replaced.

    The budget is `percent` of all tokens. Null languages and sources count as the empty name. Rows
    without tokens cost nothing and stay, once. Rows with the same id are taken or left together. An
    empty table gives an empty result.
    """
    named = docs.select(
        *[F.col(f"`{c}`") for c in docs.columns if c.lower() != "mix"],
        F.struct(domain.alias("domain"), present(F.col(lang_col)).alias("lang"), present(F.col(source_col)).alias("source"),
                 token_count(F.col(text_col)).alias("tokens")).alias("mix"))
    slim = stored(named.select(F.col(id_col).cast("bigint").alias("id"), "mix.*"), "mix-tokens")
    leaves = slim.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    whole = leaves.agg(F.floor(F.coalesce(F.sum("tokens"), F.lit(0)) * percent / 100).cast("bigint").alias("b"))
    budget = whole.select("b").scalar()
    shares = stored(budgets(leaves, budget, weights, LEVELS, epochs), "mix-shares")
    safe = F.greatest("tokens", F.lit(1))
    plan = shares.select(*LEVELS, F.expr("granted div greatest(tokens, 1)").cast("int").alias("full"), F.pmod("granted", safe).alias("rest"))

    # Where the last epoch's prefix ends: whole ranges of the order key first, then rows of one range.
    keyed = slim.filter("tokens > 0").join(plan, LEVELS).withColumn("h", order_key(seed, F.col("full"), F.col("id")))
    keyed = keyed.withColumn("range", F.substring("h", 1, DIGITS))
    sums = keyed.groupBy(*LEVELS, "range", "rest").agg(F.sum("tokens").alias("inside"))
    running = W.partitionBy(*LEVELS).orderBy("range").rowsBetween(W.unboundedPreceding, 0)
    sums = sums.withColumn("upto", F.sum("inside").over(running)).filter("upto > rest")
    ends = sums.groupBy(*LEVELS).agg(F.min(F.struct("range", (F.col("rest") - F.col("upto") + F.col("inside")).alias("left"))).alias("e"))
    ends = stored(ends.select(*LEVELS, F.col("e.range").alias("range"), F.col("e.left").alias("left")), "mix-ends")
    last = keyed.join(ends, [*LEVELS, "range"])
    last = last.withColumn("sum", F.sum("tokens").over(W.partitionBy(*LEVELS).orderBy("h", "id"))).filter(F.col("sum") <= F.col("left"))
    last = last.groupBy(*LEVELS).agg(F.max("h").alias("h"))
    cuts = stored(
        plan.join(ends, LEVELS, "left").join(last, LEVELS, "left")
        .select(*[F.col(x).alias(f"_{x}") for x in LEVELS], F.col("full").alias("_full"), F.coalesce("h", "range").alias("_cut")), "mix-cuts")

    # A row a leaf: Spark broadcasts it if its measured size allows. Keys above keep texts unmoved.
    on = [F.col(f"mix.{x}") == F.col(f"_{x}") for x in LEVELS]
    joined = named.join(cuts, on)
    taken = order_key(seed, F.col("_full"), F.col(id_col).cast("bigint")) <= F.col("_cut")
    copies = F.when(F.col("mix.tokens") == 0, 1).otherwise(F.col("_full") + F.coalesce(taken, F.lit(False)).cast("int"))
    rows = joined.filter(copies > 0).withColumn("_epoch", F.explode(F.sequence(F.lit(0), copies - 1)))
    out = [F.col(f"`{c}`") for c in named.columns if c != "mix"]
    return rows.select(*out, F.col("mix").withField("epoch", F.col("_epoch")).alias("mix"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", "source")
    rows = mix(docs, domain_of(F.col("source")))
    return rows.select("doc_id", F.col("mix.domain").alias("domain"), F.col("mix.lang").alias("lang"), F.col("mix.source").alias("source"),
                       F.col("mix.tokens").alias("tokens"), F.col("mix.epoch").alias("epoch"))


def _oracle() -> str:
    """The same in SQL: one step a level, then a running sum over each leaf's last epoch."""
    case = lambda level: "case " + " ".join(f"when {level} = '{k}' then {w}" for k, w in WEIGHTS[level].items()) + " else 1 end"
    parts = ["""d as (select doc_id, coalesce(lang, '') as lang, coalesce(source, '') as source,
 case when left(md5(coalesce(source, '')), 1) < '8' then 'web' when left(md5(coalesce(source, '')), 1) < 'c' then 'books' else 'code' end as domain,
 len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as tokens from documents)""",
             "leaves as (select domain, lang, source, sum(tokens)::bigint as tokens from d group by all)",
             "g0 as (select least(sum(tokens) * 50 // 100, sum(tokens) * 3) as granted from leaves)"]
    for i, level in enumerate(LEVELS):
        path, up = ", ".join(LEVELS[: i + 1]), ", ".join(LEVELS[:i])
        part = f"partition by {up} " if up else ""
        join = f"join g{i} using ({up})" if up else "cross join g0"
        parts.append(f"""n{i} as (select {path}, {case(level)} as w, sum(tokens) * 3 as cap from leaves group by {path})""")
        parts.append(f"""l{i} as (select *, (granted - coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0))::double
 / (sum(w) over (o rows between current row and unbounded following))::double as water
 from n{i} {join} window o as ({part}order by cap / w, {level}))""")
        parts.append(f"g{i + 1} as (select {path}, least(cap, floor(w * max(water) over ({part})))::bigint as granted from l{i})")
    parts.append("""k as (select d.*, granted // greatest(leaves.tokens, 1) as full_, granted % greatest(leaves.tokens, 1) as rest
 from d join leaves using (domain, lang, source) join g3 using (domain, lang, source))""".replace("d.*", "d.doc_id, domain, lang, source, d.tokens"))
    parts.append("""s as (select *, sum(tokens) over (partition by domain, lang, source
 order by md5(concat('5:', full_::varchar, ':', doc_id::varchar)), doc_id) as upto from k)""")
    return "with " + ",\n".join(parts) + """
select doc_id, domain, lang, source, tokens::bigint as tokens, unnest(range(0, copies))::int as epoch
from (select *, case when tokens = 0 then 1 else full_ + (upto <= rest)::int end as copies from s) where copies > 0"""


ORACLE = _oracle()
