"""Bound queries: transactions, itemsets, rules, sequences."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from sifter.functions.exprs import LABELS_5, item
from sifter.operators import binning, patterns
from sifter.operators.ranks import measured, modes
from sifter.plans.common import R, finish, own, probs_sql, sale, sql_bin, sql_labels, with_sale
from sifter.sources.tables import events

QUERIES: dict = {}
ORACLE: dict = {}


def query(name, sql=None, cte=True):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_sale(sql) if cte else sql
        return fn

    return deco


TX_COLS = ["zone", "qual", "cond", "garage_type", "priceBin"]
MIN_SUP, MIN_CONF, MAX_LEN = 0.02, 0.2, 5
TARGET_PREFIX = "priceBin="


def _binned(spark, d):
    s = own(sale(spark, d).select("sale_id", "nbhd", "zone", "qual", "cond", "garage_type", "yr_built", "price"))
    plan = binning.fit_discretize(s.select("price"), target="price", bins=5, cols=[])
    return plan.transform(s)


def _tx(spark, d):
    return patterns.transactions(_binned(spark, d), TX_COLS, "sale_id")


BINNED_SQL = f"""e_price as (select quantile_cont(price, {probs_sql(5)}) as e from sale),
binned as (select s.*, {sql_bin('s.price', 'e_price.e')} as pidx,
                  {sql_labels(LABELS_5)}[{sql_bin('s.price', 'e_price.e')}] as priceBin from sale s, e_price)"""

ITEMS_SQL = "[" + ", ".join(f"'{c}=' || coalesce(cast({c} as varchar), 'nan')" for c in TX_COLS) + "]"

TX_SQL = f"""{BINNED_SQL},
tx as (select sale_id as tid, list_sort(list_distinct({ITEMS_SQL})) as items from binned)"""

def _levels_sql() -> str:
    """Frequent sets of 1 to MAX_LEN items by joins of the distinct transactions with themselves, as lists."""
    parts = ["p1 as (select [item] as items, sum(w) as freq from ti group by item having sum(w) >= (select k from nt))"]
    for n in range(2, MAX_LEN + 1):
        names = [f"x{i}" for i in range(n)]
        joins = " ".join(f"join fi {b} on {a}.tid = {b}.tid and {a}.item < {b}.item" for a, b in zip(names, names[1:]))
        parts.append(f"p{n} as (select [{', '.join(x + '.item' for x in names)}] as items, sum(x0.w) as freq from fi x0 {joins} "
                     "group by all having sum(x0.w) >= (select k from nt))")
    union = " union all ".join(f"select items, {n} as length, cast(freq as bigint) as freq from p{n}" for n in range(1, MAX_LEN + 1))
    head, rest = parts[0], parts[1:]
    fi = "fi as materialized (select ti.* from ti where item in (select items[1] from p1))"
    return ",\n".join([head, fi, *rest, f"itemsets as ({union})"])


ITEMSETS_SQL = f"""{TX_SQL},
dtx as materialized (select row_number() over () as tid, items, w from (select items, count(*) as w from tx group by items)),
ti as materialized (select tid, w, unnest(items) as item from dtx),
nt as materialized (select count(*) as n, cast(ceil({MIN_SUP} * count(*) - 1e-9) as bigint) as k from tx),
{_levels_sql()},
sup as materialized (select items, array_to_string(items, '|') as text, length, freq, cast(freq as double) / (select n from nt) as support
        from itemsets)"""

RULES_SQL = f"""{ITEMSETS_SQL},
masks as (select unnest(range(1, 31)) as m),
splits as materialized (
    select support, array_to_string(list_filter(items, lambda x, i: (m >> (i - 1)) & 1 = 1), '|') as a,
           array_to_string(list_filter(items, lambda x, i: (m >> (i - 1)) & 1 = 0), '|') as c
    from sup join masks on m < (1 << length) - 1),
rules as (select sp.a as antecedent, sp.c as consequent, sp.support, sp.support / sa.support as confidence,
                 sp.support / sa.support / sc.support as lift, sp.support - sa.support * sc.support as leverage,
                 case when sp.support / sa.support < 1 then (1 - sc.support) / (1 - sp.support / sa.support) end
                   as conviction
          from splits sp join sup sa on sa.text = sp.a join sup sc on sc.text = sp.c
          where sp.support / sa.support >= {MIN_CONF} - 1e-12)"""

RULE_COLS = (f"antecedent, consequent, {R('support', 'support')}, {R('confidence', 'confidence')}, "
             f"{R('lift', 'lift')}, {R('leverage', 'leverage')}, {R('conviction', 'conviction')}")


@query(
    "transactions",
    f"with {TX_SQL} select tid, array_to_string(items, '|') as items from tx",
)
def transactions(spark, d):
    tx = _tx(spark, d)
    return tx.select("tid", F.array_join(F.array_sort("items"), "|").alias("items"))


def _itemsets(spark, d):
    tx = _tx(spark, d)
    return patterns.frequent_itemsets(tx, MIN_SUP, MAX_LEN)


@query(
    "frequent_itemsets",
    f"with {ITEMSETS_SQL} select array_to_string(items, '|') as items, length, freq, {R('support', 'support')} from sup",
)
def frequent_itemsets(spark, d):
    fi = _itemsets(spark, d)
    return finish(fi.select(
        patterns.items_text("items").alias("items"), F.size("items").alias("length"), "freq", "support"
    ))


@query(
    "top_itemsets",
    f"""with {ITEMSETS_SQL} select array_to_string(items, '|') as items, freq, {R('support', 'support')},
        cast(row_number() over (order by freq desc, array_to_string(items, '|')) as int) as rank
        from sup order by freq desc, array_to_string(items, '|') limit 10""",
)
def top_itemsets(spark, d):
    """M6: the ten itemsets of highest support."""
    return finish(patterns.top_itemsets(_itemsets(spark, d), 10))


@query("association_rules", f"with {RULES_SQL} select {RULE_COLS} from rules")
def association_rules(spark, d):
    rules = patterns.association_rules(_itemsets(spark, d), MIN_CONF)
    return finish(patterns.rules_as_text(rules))


TARGET_FILTER = f"(consequent like '{TARGET_PREFIX}%' or consequent like '%|{TARGET_PREFIX}%')"


@query("target_rules", f"with {RULES_SQL} select {RULE_COLS} from rules where {TARGET_FILTER}")
def target_rules(spark, d):
    rules = patterns.association_rules(_itemsets(spark, d), MIN_CONF, consequent_prefix=TARGET_PREFIX)
    return finish(patterns.rules_as_text(rules))


@query(
    "rule_report",
    f"""with {RULES_SQL} select {RULE_COLS} from rules where {TARGET_FILTER}
        order by round(lift, 9) desc, antecedent, consequent limit 20""",
)
def rule_report(spark, d):
    """M6: top 20 target rules by lift (ties broken by the item text)."""
    rules = patterns.rules_as_text(
        patterns.association_rules(_itemsets(spark, d), MIN_CONF, consequent_prefix=TARGET_PREFIX)
    )
    top = rules.orderBy(F.round("lift", 9).desc(), "antecedent", "consequent").limit(20)
    return finish(top)


SWEEP = [(0.02, 0.2), (0.04, 0.3), (0.06, 0.5)]


@query(
    "threshold_sweep",
    f"""with {RULES_SQL}
        select * from (values {', '.join(f'({s}, {c})' for s, c in SWEEP)}) t(min_support, min_confidence)
        """.replace(
        "select * from (values",
        "select cast(t.min_support as double) as min_support, cast(t.min_confidence as double) as min_confidence, "
        "cast(coalesce(sum(case when r.support >= t.min_support - 1e-12 and r.confidence >= t.min_confidence - 1e-12 "
        "then 1 else 0 end), 0) as bigint) as n_rules from (values",
    ) + " left join rules r on true group by t.min_support, t.min_confidence",
)
def threshold_sweep(spark, d):
    rules = patterns.association_rules(_itemsets(spark, d), MIN_CONF)
    return patterns.threshold_sweep(rules, SWEEP)


# ---- M10 row sequences --------------------------------------------------------------
ROW_SEQ_COLS = ["zone", "qual", "cond", "garage_type", "priceBin"]
_ordered = sorted(ROW_SEQ_COLS)


@query(
    "row_sequences",
    f"with {BINNED_SQL} select sale_id as sid, "
    + " || ' > ' || ".join(f"coalesce(cast({c} as varchar), 'nan')" for c in _ordered)
    + " as sequence from binned",
)
def row_sequences(spark, d):
    seq = patterns.row_sequences(_binned(spark, d), ROW_SEQ_COLS, "sale_id")
    return seq.select("sid", F.array_join("sequence", " > ").alias("sequence"))


ROW_RATIO = 0.1


def _subsets_sql() -> str:
    """Every non-empty choice of columns of a row, in order: all its gapped subsequences."""
    parts = []
    for n in range(1, len(_ordered) + 1):
        for cols in itertools.combinations(_ordered, n):
            text = " || ' > ' || ".join(f"coalesce(cast({c} as varchar), 'nan')" for c in cols)
            parts.append(f"select sale_id as sid, {text} as pattern, {n} as length from binned")
    return " union all ".join(parts)


ROW_PATTERNS_SQL = f"""{BINNED_SQL}, subs as ({_subsets_sql()}),
        pats as (select pattern, length, count(distinct sid) as freq from subs group by all
                 having count(distinct sid) >= (select greatest(1, cast(floor({ROW_RATIO} * count(*)) as bigint)) from sale))"""


def _row_patterns(spark, d):
    """M8 on M10: frequent gapped patterns of all lengths; equal rows are counted once."""
    seq = patterns.row_sequences(_binned(spark, d), ROW_SEQ_COLS, "sale_id")
    seq = seq.groupBy("sequence").agg(F.count(F.lit(1)).alias("w"))
    steps = seq.select(F.col("sequence").alias("sid"), "w", F.posexplode("sequence").alias("pos", "it"))
    return patterns.sequential_patterns(steps, "sid", ["pos"], "it", ROW_RATIO, weight_col="w")


@query("row_sequence_patterns", f"with {ROW_PATTERNS_SQL} select pattern, length, freq from pats")
def row_sequence_patterns(spark, d):
    return patterns.patterns_as_text(_row_patterns(spark, d))


@query(
    "longest_row_patterns",
    f"""with {ROW_PATTERNS_SQL}
        select pattern, length, freq, cast(row_number() over (order by length desc, freq desc, pattern) as int) as rank
        from pats order by length desc, freq desc, pattern limit 10""",
)
def longest_row_patterns(spark, d):
    """K3: the ten longest row patterns, the most frequent first."""
    return patterns.longest_patterns(_row_patterns(spark, d), 10)


EVENT_RATIO = 0.5


#: Event sequences have no natural bound: the query asks for patterns of three steps at most.
EVENT_LENGTH = 3


def _event_patterns_sql() -> str:
    """Patterns by all ordered triples of a user's events, earliest ends first."""
    parts = [f"""k as (select greatest(1, cast(floor({EVENT_RATIO} * count(distinct user_id)) as bigint)) as k from events),
        e as (select user_id, event_type as it, row_number() over (partition by user_id order by ts, event_id) as pos
              from events where user_id is not null),
        h1 as (select user_id, it as pattern, min(pos) as fin from e where it is not null group by all)"""]
    for n in range(2, EVENT_LENGTH + 1):
        parts.append(f"h{n} as (select h.user_id, h.pattern || ' > ' || e.it as pattern, min(e.pos) as fin from h{n - 1} h "
                     "join e on e.user_id = h.user_id and e.pos > h.fin where e.it is not null group by all)")
    union = " union all ".join(f"select pattern, {n} as length, count(*) as freq from h{n} group by pattern "
                               "having count(*) >= (select k from k)" for n in range(1, EVENT_LENGTH + 1))
    return ",\n".join([*parts, f"pats as ({union})"])


@query("sequential_patterns", f"with {_event_patterns_sql()} select pattern, length, freq from pats", cte=False)
def sequential_patterns(spark, d):
    """M8: per user, event types ordered by (ts, event_id)."""
    ev = events(spark, d).where(F.col("user_id").isNotNull())
    p = patterns.sequential_patterns(ev, "user_id", ["ts", "event_id"], "event_type", EVENT_RATIO, EVENT_LENGTH)
    return patterns.patterns_as_text(p)


# Sessions of a user's events (those of one day) end by themselves: no length is asked for.
SESSION_RATIO = 0.01


@query(
    "session_patterns",
    f"""with recursive e as (select user_id, cast(ts as date) as day, event_type as it,
                row_number() over (partition by user_id, cast(ts as date) order by ts, event_id) as pos
              from events where user_id is not null),
        k as (select greatest(1, cast(floor({SESSION_RATIO} * count(*)) as bigint)) as k from (select distinct user_id, day from e)),
        subs as (select user_id, day, it as pattern, 1 as length, min(pos) as fin from e where it is not null group by all
                 union all
                 select user_id, day, pattern, length, fin from (
                   select s.user_id, s.day, s.pattern || ' > ' || e.it as pattern, s.length + 1 as length, min(e.pos) as fin
                   from subs s join e on e.user_id = s.user_id and e.day = s.day and e.pos > s.fin
                   where e.it is not null group by all))
        select pattern, cast(length as int) as length, count(*) as freq from subs group by all having count(*) >= (select k from k)""",
    cte=False,
)
def session_patterns(spark, d):
    """M8 of all lengths: a user's event types of one day, in order of (ts, event_id)."""
    ev = events(spark, d).where(F.col("user_id").isNotNull())
    ev = ev.withColumn("session", F.struct("user_id", F.to_date("ts").alias("day")))
    p = patterns.sequential_patterns(ev, "session", ["ts", "event_id"], "event_type", SESSION_RATIO)
    return patterns.patterns_as_text(p)


# ---- M9 group evolution -------------------------------------------------------------------
STEPS_SQL = f"""{BINNED_SQL},
dd as (select nbhd, cast(floor(try_cast(yr_built as double) / 10) * 10 as bigint) as decade, qual, pidx from binned
       where yr_built is not null and pidx is not null),
mq as (select nbhd, decade, qual from (select nbhd, decade, qual,
         row_number() over (partition by nbhd, decade order by count(*) desc, qual) as rn
       from dd where qual is not null group by nbhd, decade, qual) where rn = 1),
mp as (select nbhd, decade, pidx from (select nbhd, decade, pidx,
         row_number() over (partition by nbhd, decade order by count(*) desc, pidx) as rn
       from dd group by nbhd, decade, pidx) where rn = 1),
st as (select mp.nbhd, mp.decade, 'Q:' || coalesce(mq.qual, 'nan') || '_P:' || {sql_labels(LABELS_5)}[mp.pidx] as item
       from mp left join mq on mp.nbhd = mq.nbhd and mp.decade = mq.decade),
sq as (select nbhd from st group by nbhd having count(*) >= 2),
steps as (select st.* from st join sq using (nbhd))"""


def _evolution_steps(spark, d):
    b = _binned(spark, d)
    idx = F.array_position(F.array(*[F.lit(x) for x in LABELS_5]), F.col("priceBin"))
    dd = b.select(
        "nbhd", F.floor(F.col("yr_built").try_cast("double") / 10).cast("long").alias("_d"), "qual",
        idx.alias("pidx"),
    ).withColumn("decade", F.col("_d") * 10).drop("_d").where(
        F.col("decade").isNotNull() & F.col("pidx").isNotNull()
    )
    dd = measured(dd.groupBy("nbhd", "decade", "qual", "pidx").agg(F.count(F.lit(1)).alias("n")), "evolution-counts")
    mq = modes(dd, "qual", ["nbhd", "decade"], weight="n").select("nbhd", "decade", F.col("mode").alias("qual"))
    mp = modes(dd, "pidx", ["nbhd", "decade"], weight="n").select("nbhd", "decade", F.col("mode").alias("pidx"))
    labels = F.array(*[F.lit(x) for x in LABELS_5])
    st = mp.join(mq, ["nbhd", "decade"], "left").select(
        "nbhd", "decade",
        F.concat(F.lit("Q:"), F.coalesce("qual", F.lit("nan")), F.lit("_P:"), F.element_at(labels, F.col("pidx").cast("int"))).alias("item"),
    )
    return st


@query(
    "group_sequences",
    f"""with {STEPS_SQL}
        select nbhd, string_agg(item, ' > ' order by decade) as sequence, count(*) as n_steps
        from steps group by nbhd""",
)
def group_sequences(spark, d):
    seq = patterns.group_sequences(_evolution_steps(spark, d), "nbhd", "decade", "item", min_length=2)
    return seq.select("nbhd", F.array_join("sequence", " > ").alias("sequence"), F.size("sequence").cast("long").alias("n_steps"))


# The bound data are random, so the evolution items are sparse; a lower ratio
# than the reference run (0.2) keeps the pattern table non-empty.
EVOLUTION_RATIO = 0.1


@query(
    "group_evolution",
    f"""with recursive {STEPS_SQL},
        subs as (select nbhd, decade, item as pattern, 1 as length from steps union all
                 select s.nbhd, t.decade, s.pattern || ' > ' || t.item, s.length + 1 from subs s
                 join steps t on s.nbhd = t.nbhd and t.decade > s.decade),
        pats as (select pattern, length, count(distinct nbhd) as freq from subs group by all
                 having count(distinct nbhd) >= (select greatest(1, cast(floor({EVOLUTION_RATIO} * count(*)) as bigint)) from sq))
        select pattern, length, freq from pats where length >= 2""",
)
def group_evolution(spark, d):
    """M9: evolution patterns of two steps and more over the group sequences."""
    st = measured(_evolution_steps(spark, d), "evolution-steps")
    keep = st.groupBy("nbhd").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= 2).select("nbhd")
    p = patterns.sequential_patterns(st.join(keep, "nbhd"), "nbhd", ["decade"], "item", EVOLUTION_RATIO)
    return patterns.patterns_as_text(p).where(F.col("length") >= 2)
