"""Registered queries over the test tables, each with SQL for the same rows where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymark.functions import geo
from tallymark.functions.des import des_decrypt, des_encrypt
from tallymark.functions.ids import combined_id, from_long_form, md5_id, to_long_form
from tallymark.functions.ip import LONG_NAMES, MUNICIPALITIES, PROVINCES, REGIONS, ip_number, province_city
from tallymark.functions.records import app_record, first_geo, impressions
from tallymark.operators import evaluation, features, programs, samples, tagging
from tallymark.operators import matches as matching
from tallymark.operators.arrays import latest_merge, sum_maps
from tallymark.operators.learners import StackingClassifier, boosted_trees, sparse_logistic
from tallymark.operators.lookups import college_places, hash_lookup, range_lookup, within_radius
from tallymark.operators.rules import once
from tallymark.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(sql: str | None = None):
    def add(query: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return query(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        QUERIES[query.__name__] = run
        if sql:
            SQL[query.__name__] = sql
        return query

    return add


def occurrences(column: str, word: str) -> str:
    """SQL that counts a word that cannot overlap itself."""
    return f"((length({column}) - length(replace({column}, '{word}', ''))) // {len(word)})"


def fixed(column: Column, digits: int = 4) -> Column:
    """A double as a whole number of 10**-digits."""
    return F.floor(column * float(10**digits) + 0.5).cast("long")


def fixed_sql(expression: str, digits: int = 4) -> str:
    return f"floor(({expression}) * {float(10**digits)} + 0.5)::bigint"


# Rules over documents: a line is source:doc_id:text.


def _document_lines(read) -> DataFrame:
    return read("documents").select(F.col("doc_id").alias("userid"), F.lit("20240101").alias("date"), F.array(F.concat_ws(":", "source", "doc_id", "text")).alias("data"))


@register(f"""
with d as (select doc_id as userid, {occurrences("coalesce(text, '')", "tion")} as a, {occurrences("coalesce(text, '')", "the")} as t, {occurrences("coalesce(text, '')", "ing")} as g from documents),
s as (select userid, a, case when g > 0 then least(t, 0) else least(t, 1) end as b from d)
select userid, case when a > 0 then a::int end as t_ion, case when b > 0 then b::int end as t_and_not from s where a <> 0 or b <> 0
""")
def rule_tag_direct(read) -> DataFrame:
    rules = ["data_word=all:0:tion", "data_word=all:0:the & (!data_word=all:0:ing)"]
    found = tagging.row_tag_map(_document_lines(read), rules, ["t_ion", "t_and_not"])
    return found.select("userid", *[F.try_element_at("tags", F.lit(k)).alias(k) for k in ("t_ion", "t_and_not")])


@register(f"""
with d as (select doc_id as userid, source, coalesce(text, '') as x from documents),
c as (select userid, {occurrences("x", "tion")} + {occurrences("x", "ing")} as s0, {occurrences("x", "the")} as the, {occurrences("x", "und")} as und, {occurrences("x", "que")} as que, {occurrences("x", "les")} as les, case when source in ('src1', 'src2') then {occurrences("x", "er")} else 0 end as s3 from d),
s as (select userid, s0, case when und > 0 then 0 else the end as s1, least(que, les) as s2, s3 from c)
select userid, s0::int as s0, s1::int as s1, s2::int as s2, s3::int as s3, ((case when s0 between 2 and 30 then s0 else 0 end) + s1)::int as t0, (s2 + s3)::int as t1 from s where s0 <> 0 or s1 <> 0 or s2 <> 0 or s3 <> 0
""")
def rule_combo_threshold(read) -> DataFrame:
    rules = ["data_word=all:0:{tion,ing}[2-30],the-und", "data_word=all:0:que+les | data_word=src1,src2:0:er"]
    found = tagging.with_tags(_document_lines(read), rules).where(F.exists("scores", lambda x: x != 0))
    return found.select("userid", *[F.col("scores")[k].alias(f"s{k}") for k in range(4)], *[F.col("tags")[k].alias(f"t{k}") for k in range(2)])


@register(f"""
with c as (select conv_id as userid, {occurrences("coalesce(text, '')", "er")} as n, role = 'user' as q from conversations),
s as (select userid, sum(n)::int as s0, coalesce(sum(n) filter (q), 0)::int as s1 from c group by userid)
select userid, s0, s1 from s where s0 <> 0 or s1 <> 0
""")
def rule_query_flag(read) -> DataFrame:
    line = F.concat(F.coalesce("role", F.lit("")), F.lit(":"), F.col("turn").cast("string"), F.lit(":"), F.coalesce("text", F.lit("")), F.when(F.coalesce(F.col("role") == "user", F.lit(False)), ":1").otherwise(":0"))
    lines = read("conversations").select(F.col("conv_id").alias("userid"), F.array(line).alias("data"))
    found = tagging.user_tags(tagging.sub_scores(lines, ["data_word=all:0:er", "data_word=all:1:er"]), ["data_word=all:0:er", "data_word=all:1:er"])
    return found.select("userid", F.col("tags")[0].alias("s0"), F.col("tags")[1].alias("s1"))


@register(f"""
with d as (select doc_id as userid, {occurrences("coalesce(text, '')", "the")} as a, {occurrences("coalesce(text, '')", "que")} as b, {occurrences("coalesce(text, '')", "sch")} as c from documents)
select userid, a::int as tag_0, b::int as tag_1, c::int as tag_2, case when a > greatest(b, c) then 0.0::double when b > greatest(a, c) then 1.0::double else 2.0::double end as label
from d where a > greatest(b, c) or b > greatest(a, c) or c > greatest(a, b)
""")
def sample_label_argmax(read) -> DataFrame:
    found = tagging.with_label(_document_lines(read), [f"data_word=all:0:{w}" for w in ("the", "que", "sch")])
    return found.select("userid", *[F.col("tags")[k].alias(f"tag_{k}") for k in range(3)], "label")


_MANY_WORDS = [a + b for a in ("th", "in", "er", "qu", "sch", "ei", "on") for b in ("e", "g", "en", "i")]


def _overlapping(column: str, word: str) -> str:
    """SQL that counts a word whose occurrences may share their one end: where it is doubled they do not."""
    shared = word[0]
    return occurrences(f"replace({column}, '{shared}', '{shared}{shared}')" if word[-1] == shared else column, word)


@register(f"""
with d as (select doc_id as userid, coalesce(text, '') as x from documents), t as (select userid, {", ".join(f"({' + '.join(_overlapping('x', w) for w in _MANY_WORDS[k::4])})::int as t{k}" for k in range(4))} from d)
select * from t where {" or ".join(f"t{k} <> 0" for k in range(4))}
""")
def rule_many_words(read) -> DataFrame:
    """Enough words for the automaton."""
    words = _MANY_WORDS
    rules = [f"data_word=all:0:{','.join(words[k::4])}" for k in range(4)]
    return tagging.row_tags(_document_lines(read), rules).select("userid", *[F.col("tags")[k].alias(f"t{k}") for k in range(4)])


#: Words of which some lie in others; none overlaps itself.
_NESTED = ["tion", "ion", "the", "he", "then", "sch", "und", "der", "er", "que", "ción", "qu"]
_RARE = ["benchmark", "license", "@", "password", "zz"]


@register(f"""
with w as (select unnest({_NESTED}) as word), p as (select doc_id, word, string_split(text, word) as parts from documents, w where text is not null),
u as (select doc_id, word, unnest(parts) as part, unnest(range(len(parts))) as k, len(parts) as n from p where len(parts) > 1),
b as (select doc_id, word, k, n, sum(length(part)) over (partition by doc_id, word order by k) + k * length(word) as place from u)
select doc_id, word, count(*)::bigint as n, sum(place)::bigint as begins, sum(place + length(word))::bigint as ends from b where k < n - 1 group by doc_id, word
""")
def word_matches(read) -> DataFrame:
    each = read("documents").select("doc_id", F.inline(matching.matches(F.col("text"), _NESTED)))
    return each.groupBy("doc_id", "word").agg(F.count("*").alias("n"), F.sum("begin").alias("begins"), F.sum("end").alias("ends"))


@register(f"select doc_id, list_aggregate(list_sort([w for w in {_NESTED} if contains(text, w)]), 'string_agg', ',') as words from documents where text is not null")
def word_matches_distinct(read) -> DataFrame:
    found = read("documents").where("text is not null").select("doc_id", matching.matched_words(F.col("text"), _NESTED).alias("w"))
    return found.select("doc_id", F.when(F.size("w") > 0, F.concat_ws(",", "w")).alias("words"))


@register(f"select doc_id, {' or '.join(f"contains(text, '{w}')" for w in _RARE)} as found from documents")
def word_matches_any(read) -> DataFrame:
    return read("documents").select("doc_id", matching.has_match(F.col("text"), _RARE).alias("found"))


#: Words of two different letters, so that none overlaps itself.
_SYLLABLES = [a + b for a in "bcdfghjklmnpqrstvwxz" for b in "aeiou"]


@register(f"""
with w as (select unnest({_SYLLABLES}) as w, unnest(range({len(_SYLLABLES)})) as k),
c as (select doc_id, k, ((length(x) - length(replace(x, w, ''))) // 2)::int as n from (select doc_id, coalesce(text, '') as x from documents), w),
t as (select a.doc_id, a.k * {len(_SYLLABLES)} + b.k as place, least(a.n, b.n) as score from c a join c b on a.doc_id = b.doc_id and a.n > 0 and b.n > 0),
s as (select doc_id, count(*)::int as n_tags, sum(score)::bigint as total, sum((place % 997) * score)::bigint as weighted from t group by doc_id)
select d.doc_id, coalesce(n_tags, 0)::int as n_tags, coalesce(total, 0)::bigint as total, coalesce(weighted, 0)::bigint as weighted,
  case when regexp_full_match(source, 'src[0-9]{{1,5}}') then {occurrences("coalesce(text, '')", "the")} else 0 end::int as by_apps from documents d left join s using (doc_id)
""")
def rule_thousands(read) -> DataFrame:
    """Ten thousand rules, and one that names a hundred thousand apps, as one program."""
    pairs = [f"data_word=all:0:{a}+{b}" for a in _SYLLABLES for b in _SYLLABLES]
    apps = f"data_word={','.join(f'src{k}' for k in range(100_000))}:0:the"
    found = programs.with_program_tags(_document_lines(read).select(F.col("userid").alias("doc_id"), "data"), [*pairs, apps])
    number = lambda value: value.cast("long")
    pair = lambda x: x["place"] < len(pairs)
    start = F.struct(*[F.lit(0).cast("long").alias(k) for k in ("n_tags", "total", "weighted", "by_apps")])
    add = lambda acc, x: F.struct(
        (acc["n_tags"] + number(pair(x))).alias("n_tags"),
        (acc["total"] + F.when(pair(x), x["score"]).otherwise(0)).alias("total"),
        (acc["weighted"] + F.when(pair(x), (x["place"] % 997) * number(x["score"])).otherwise(0)).alias("weighted"),
        (acc["by_apps"] + F.when(pair(x), 0).otherwise(x["score"])).alias("by_apps"),
    )
    sums = once(found.select("doc_id", "tags"), "_s", F.aggregate("tags", start, add))  # one pass over a row's tags, which may be thousands
    return sums.select("doc_id", F.col("_s.n_tags").cast("int").alias("n_tags"), "_s.total", "_s.weighted", F.col("_s.by_apps").cast("int").alias("by_apps"))


# Rules over events: a user's day is a row; a line is event_type:event_id:props:flag.

EVENT_RULES = ["data_word=click,view:0:{9}[5-60]", "data_word=all:1:1+2,3", "apps_days=click+view & !apps_freq=signup", "(apps_list=purchase|apps_freq=error)\r3-30\f"]


def _event_rows(read) -> DataFrame:
    line = F.concat_ws(":", "event_type", F.col("event_id").cast("string"), "props", F.when(F.col("value") > 50, "1").otherwise("0"))
    return read("events").groupBy(F.col("user_id").alias("userid"), F.date_format("ts", "yyyyMMdd").alias("date")).agg(F.sort_array(F.collect_list(line)).alias("data"))


_EVENT_SLOTS = f"""
e as (select user_id as userid, strftime(ts, '%Y%m%d') as date, event_type as app, coalesce(value > 50, false) as q, coalesce(props, '') as p from events),
r as (select userid, date, coalesce(sum({occurrences("p", "9")}) filter (app in ('click', 'view')), 0) as s0,
  least(coalesce(sum({occurrences("p", "1")}) filter (q), 0), coalesce(sum({occurrences("p", "2")}) filter (q), 0)) as s1, coalesce(sum({occurrences("p", "3")}) filter (q), 0) as s2,
  (count(*) filter (app = 'click') > 0)::int as s3, (count(*) filter (app = 'view') > 0)::int as s4, count(*) filter (app = 'signup') as s5, (count(*) filter (app = 'purchase') > 0)::int as s6, count(*) filter (app = 'error') as s7 from e group by userid, date)
"""


_EVENT_TAGS = f"""
with {_EVENT_SLOTS},
u as (select userid, {", ".join(f"sum(s{k})::int as s{k}" for k in range(8))} from r group by userid),
t as (select *, case when s0 between 5 and 60 then s0 else 0 end as t0, s1 + s2 as t1, least(least(s3, s4), case when s5 > 0 then 0 else 1 end) as t2, case when s6 + s7 between 3 and 30 then s6 + s7 else 0 end as t3 from u)
select userid, {", ".join(f"s{k}" for k in range(8))}, {", ".join(f"t{k}::int as t{k}" for k in range(4))} from t where t0 <> 0 or t1 <> 0 or t2 <> 0 or t3 <> 0
"""


@register(_EVENT_TAGS)
def rule_two_phase(read) -> DataFrame:
    found = tagging.user_tags(tagging.sub_scores(_event_rows(read), EVENT_RULES), EVENT_RULES)
    return found.select("userid", *[F.col("sub_scores")[k].alias(f"s{k}") for k in range(8)], *[F.col("tags")[k].alias(f"t{k}") for k in range(4)])


@register(_EVENT_TAGS)
def rule_program_two_phase(read) -> DataFrame:
    """The same by a compiled program: sparse slots of a day, summed by user."""
    found = programs.program_user_tags(programs.with_program_slots(_event_rows(read), EVENT_RULES), EVENT_RULES)
    place = lambda column, k: F.coalesce(F.get(F.filter(column, lambda x: x["place"] == k), F.lit(0))["score"], F.lit(0))
    return found.select("userid", *[place("slots", k).alias(f"s{k}") for k in range(8)], *[place("tags", k).alias(f"t{k}") for k in range(4)])



@register(f"with {_EVENT_SLOTS} select userid, {', '.join(f's{k}::int as s{k}' for k in range(8))} from r where {' or '.join(f's{k} <> 0' for k in range(8))}")
def rule_sub_scores(read) -> DataFrame:
    return tagging.sub_scores(_event_rows(read), EVENT_RULES).select("userid", *[F.col("sub_scores")[k].alias(f"s{k}") for k in range(8)])


def _app_rows(read) -> DataFrame:
    each = read("events").groupBy(F.col("user_id").alias("userid"), F.date_format("ts", "yyyyMMdd").alias("date"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))
    record = F.concat_ws(":", "event_type", F.col("n").cast("string"), F.floor("v").cast("string"), F.lit("0"))
    return each.groupBy("userid", "date").agg(F.sort_array(F.collect_list(record)).alias("apps"))


@register("""
with r as (select user_id as userid, strftime(ts, '%Y%m%d') as date, (count(*) filter (event_type = 'click') > 0)::int as days, (count(*) filter (event_type = 'view'))::int as freq, (count(*) filter (event_type = 'error') > 0)::int as list from events group by 1, 2)
select * from r where days <> 0 or freq <> 0 or list <> 0
""")
def rule_app_atoms(read) -> DataFrame:
    found = tagging.row_tags(_app_rows(read), ["apps_days=click", "apps_freq=view", "apps_list=error"])
    return found.select("userid", "date", F.col("tags")[0].alias("days"), F.col("tags")[1].alias("freq"), F.col("tags")[2].alias("list"))


# Samples.

_DAY_LINES = "select user_id as userid, strftime(ts, '%Y%m%d') as date, list(event_type || ':' || event_id order by event_type || ':' || event_id) as data from events group by 1, 2"


def _day_lines(read) -> DataFrame:
    return read("events").groupBy(F.col("user_id").alias("userid"), F.date_format("ts", "yyyyMMdd").alias("date")).agg(F.sort_array(F.collect_list(F.concat_ws(":", "event_type", F.col("event_id").cast("string")))).alias("data"))


@register(f"""
with r as ({_DAY_LINES}), m as (select userid, max(date) as date, flatten(list(data order by date)) as data from r group by userid)
select userid, date, least(len(data), 40)::int as n, array_to_string(data[greatest(len(data) - 39, 1):], ',') as lines from m
""")
def latest_capped_merge(read) -> DataFrame:
    found = latest_merge(_day_lines(read), "userid", "date", "data", 40)
    return found.select("userid", "date", F.size("data").alias("n"), F.array_join("data", ",").alias("lines"))


_LABEL_RULES = ["apps_freq=click|apps_freq=view", "apps_freq=error|apps_freq=signup"]
_LABEL_DAYS = "select user_id as userid, strftime(ts, '%Y%m%d') as date, count(*) filter (event_type in ('click', 'view')) as a, count(*) filter (event_type in ('error', 'signup')) as b, list(event_type || ':' || event_id || ':' order by event_type || ':' || event_id || ':') as data from events group by 1, 2"


def _label_rows(read) -> DataFrame:
    return read("events").groupBy(F.col("user_id").alias("userid"), F.date_format("ts", "yyyyMMdd").alias("date")).agg(F.sort_array(F.collect_list(F.concat("event_type", F.lit(":"), F.col("event_id").cast("string"), F.lit(":")))).alias("data"))


@register(f"""
with r as (select * from ({_LABEL_DAYS}) where a <> b), m as (select userid, max(date) as date, sum(a) as a, sum(b) as b, flatten(list(data order by date)) as data from r group by userid)
select userid, date, least(len(data), 30)::int as n, case when a > b then 0.0::double else 1.0::double end as label from m where a <> b
""")
def label_then_merge(read) -> DataFrame:
    found = samples.label_then_merge(_label_rows(read), _LABEL_RULES, limit=30)
    return found.select("userid", "date", F.size("data").alias("n"), "label")


@register(f"""
with m as (select userid, max(date) as date, flatten(list(data order by date)) as data from ({_LABEL_DAYS}) group by userid), k as (select userid, date, data[greatest(len(data) - 29, 1):] as data from m),
c as (select userid, date, len(data) as n, len([x for x in data if split_part(x, ':', 1) in ('click', 'view')]) as a, len([x for x in data if split_part(x, ':', 1) in ('error', 'signup')]) as b from k)
select userid, date, n::int as n, case when a > b then 0.0::double else 1.0::double end as label from c where a <> b
""")
def merge_then_label(read) -> DataFrame:
    found = samples.merge_then_label(_label_rows(read), _LABEL_RULES, limit=30)
    return found.select("userid", "date", F.size("data").alias("n"), "label")


@register("select o_orderkey, o_orderpriority from orders where strftime(o_orderdate, '%Y%m%d') between '19970101' and '19970331' and o_orderpriority not like '%URG%' and length(o_orderpriority) > 1 and o_orderpriority not like '%oem%'")
def date_window_public(read) -> DataFrame:
    orders = read("orders").withColumn("date", F.date_format("o_orderdate", "yyyyMMdd")).where(~F.col("o_orderpriority").contains("URG"))
    return orders.where(samples.last_days(F.col("date"), "19970331", 90) & samples.public_version(F.col("o_orderpriority"))).select("o_orderkey", "o_orderpriority")


def draw_sql(key: str, seed: int = 17) -> str:
    return f"('0x' || substr(md5('{seed}:' || {key}), 1, 8))::bigint"


@register(f"""
with n as (select quality, count(*) as n from labels where quality in (0, 1) group by quality)
select doc_id, quality, toxic, quality::double as label from labels join n using (quality) where {draw_sql("doc_id")} * n < 100 * 4294967296
""")
def balanced_sample(read) -> DataFrame:
    return samples.balanced(read("labels").withColumn("label", F.col("quality").cast("double")), 100, key="doc_id")


@register(f"select o_orderkey, o_custkey from orders where {draw_sql('o_orderkey', 5)} < {round(0.2 * (1 << 32))}")
def uniform_sample(read) -> DataFrame:
    return samples.uniform(read("orders").select("o_orderkey", "o_custkey"), 0.2, 5, "o_orderkey")


@register("select supplier.* from supplier")
def buffered_rows(read) -> DataFrame:
    return samples.buffered(read("supplier"), buffer_size=16, refill=4, seed=3)


@register("select quality, count(*) as n from labels group by quality")
def count_by_label(read) -> DataFrame:
    return read("labels").groupBy("quality").agg(F.count(F.lit(1)).alias("n"))


@register(f"""
with p as (select c_custkey, case when {draw_sql("c_custkey")} < {round(0.7 * (1 << 32))} then 1 else 2 end as part from customer)
select count(*) as n, count(distinct c_custkey) as keys, 0::bigint as in_both, count(*) filter (part = 1) as first_part from p
""")
def hash_split(read) -> DataFrame:
    a, b = samples.hash_split(read("customer"), "c_custkey")
    both = a.select("c_custkey", F.lit(1).alias("part")).unionByName(b.select("c_custkey", F.lit(2).alias("part")))
    per = both.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("part").alias("parts"), F.min("part").alias("first"))
    return per.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("keys"), F.sum(F.when(F.col("parts") > 1, 1).otherwise(0)).cast("long").alias("in_both"), F.sum((F.col("first") == 1).cast("long")).alias("first_part"))


@register("select s_suppkey, 3::bigint as n from supplier")
def epochs(read) -> DataFrame:
    return samples.shuffled(samples.epochs(read("supplier"), 3), partition_local=True).groupBy("s_suppkey").agg(F.count(F.lit(1)).alias("n"))


# Dictionaries, joins and features.


@register("select event_type as name, count(*) as n from events group by 1 order by n desc, name limit 3")
def top_k_apps(read) -> DataFrame:
    rows = _app_rows(read).select(F.explode("apps").alias("r")).select(F.array_repeat(F.col("r"), app_record(F.col("r"))["freq"]).alias("apps"))
    return features.top_names(rows, "apps", 3)


@register("""
with v as (select distinct 'lang' as field, coalesce(lang, '-1') as value from documents union select distinct 'source', coalesce(source, '-1') from documents)
select field, value, (row_number() over (partition by field order by value) - 1)::int as index from v
""")
def category_dictionary(read) -> DataFrame:
    return features.category_dictionary(read("documents"), ["lang", "source"])


@register("select doc_id, lang, coalesce(code, 1)::int as code from documents left join (values ('en', 7), ('fr', 8)) as d(lang, code) using (lang)")
def hash_lookup_default(read) -> DataFrame:
    documents = read("documents").select("doc_id", "lang")
    entries = documents.sparkSession.createDataFrame([("en", 7), ("fr", 8)], "lang string, code int")
    return hash_lookup(documents, entries, "lang", "code", 1)


@register("select doc_id, source, quality from documents join labels using (doc_id)")
def join_inner(read) -> DataFrame:
    return read("documents").select("doc_id", "source").join(read("labels").select("doc_id", "quality"), "doc_id")


@register("select coalesce(c.c_custkey, s.s_suppkey + 1450) as id, c_name as customer, s_name as supplier from customer c full join supplier s on c.c_custkey = s.s_suppkey + 1450")
def join_full(read) -> DataFrame:
    a = read("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("customer"))
    return a.join(read("supplier").select((F.col("s_suppkey") + 1450).alias("id"), F.col("s_name").alias("supplier")), "id", "full")


VOCABULARY = ["<PAD>", "<UNK>", "<EDL>", "<QUERY>", "<NOTQUERY>", *"etaoinshrdlucmfwypvbgkqjxz .,éèêçäöüßñáíóú"]
_VOCABULARY_SQL = "map([" + ", ".join(f"'{c}'" for c in VOCABULARY if c.strip()) + "], [" + ", ".join(str(k) for k, c in enumerate(VOCABULARY) if c.strip()) + "])"


@register(f"""
with v as (select {_VOCABULARY_SQL} as m),
x as (select doc_id, list_concat(list_concat([1, 5], [coalesce(m[c], 1) for c in string_split(split_part(coalesce(text, ''), ':', 1), '') if c <> '']), [2])[1:1000] as ids from documents, v)
select doc_id, 1000::int as n, md5(array_to_string(list_concat(ids, [0 for k in range(1000 - len(ids))]), ',')) as ids_md5 from x
""")
def token_encode(read) -> DataFrame:
    encoder = features.Encoder(features.vocabulary_of(VOCABULARY), lines=len(VOCABULARY))
    line = F.concat(F.coalesce("source", F.lit("")), F.lit(":"), F.col("doc_id").cast("string"), F.lit(":"), F.coalesce("text", F.lit("")))
    ids = encoder.lines_column(F.array(line))
    return read("documents").select("doc_id", ids.alias("ids")).select("doc_id", F.size("ids").alias("n"), F.md5(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_md5"))


_APPS = ["click", "view", "purchase", "error"]


def _summed_in_order(events: DataFrame, *keys: Column) -> DataFrame:
    """(keys, n, v): how many events, and the sum of their values in the order in which the table's files hold them.

    A sum of doubles depends on its order, and its whole part with it; a sum of partial sums is that of no order of rows.
    Identifiers tell no order: they may repeat, be null, or not follow the rows.
    The running sum goes over sorted rows, which a window keeps on disk beyond its memory.
    """
    rows = events.select(*keys, "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    names = rows.columns[: len(keys)]
    until_here = Window.partitionBy(*names).orderBy("_file", "_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = rows.select(*names, F.sum("value").over(until_here).alias("_sum"), F.count(F.lit(1)).over(until_here).alias("_n"))
    return running.groupBy(*names).agg(F.max("_n").alias("n"), F.max_by("_sum", "_n").alias("v"))


@register(f"""
with e as (select user_id as userid, event_type, count(*) as n, floor(sum(value)) as v from events group by 1, 2), u as (select distinct userid from e)
select userid, {", ".join(f"coalesce(max(1.0::double) filter (event_type = '{a}'), 0.0) as has_{a}, coalesce(max(n::double) filter (event_type = '{a}'), 0.0) as freq_{a}, coalesce(max(v::double) filter (event_type = '{a}'), 0.0) as dur_{a}, coalesce(max(-1.0::double) filter (event_type = '{a}'), 0.0) as sys_{a}" for a in _APPS)} from e group by userid
""")
def app_multi_hot(read) -> DataFrame:
    each = _summed_in_order(read("events"), F.col("user_id").alias("userid"), F.col("event_type"))
    whole = F.when(F.abs("v") < 2.0**62, F.floor("v").cast("string")).otherwise(F.col("v").cast("string"))  # a value that is no number has no whole part
    record = F.concat_ws(":", "event_type", F.lit("2"), F.col("n").cast("string"), F.coalesce(whole, F.lit("")), F.lit("x"))
    encoder = features.Encoder({}, {a: k for k, a in enumerate(_APPS)})
    found = each.groupBy("userid").agg(F.collect_list(record).alias("apps")).select("userid", encoder.app_features(F.col("apps")).alias("f"))
    return found.select("userid", *[F.col(f"f.{src}")[k].alias(f"{name}_{a}") for k, a in enumerate(_APPS) for src, name in (("list", "has"), ("freq", "freq"), ("dur", "dur"), ("sys", "sys"))])


@register("""
with e as (select user_id as userid, event_type, list_position(['click', 'view', 'purchase', 'error'], event_type) - 1 as k from events group by 1, 2, 3),
l as (select userid, list(coalesce(k, 1) order by event_type) as ids from e group by userid)
select userid, array_to_string(list_concat(ids, [0 for k in range(6 - len(ids))])[1:6], ',') as ids from l
""")
def app_index(read) -> DataFrame:
    rows = read("events").groupBy(F.col("user_id").alias("userid")).agg(F.sort_array(F.collect_set("event_type")).alias("apps"))
    encoder = features.Encoder({}, {a: k for k, a in enumerate(_APPS)}, app_length=6)
    return rows.select("userid", F.array_join(encoder.app_index(F.col("apps")).cast("array<string>"), ",").alias("ids"))


@register("""
select doc_id, array_to_string([(case when coalesce(lang, '-1') = v then '1' else '0' end) for v in ['de', 'en', 'es', 'fr']], '') as lang_hot from documents
""")
def profile_one_hot(read) -> DataFrame:
    encoder = features.Encoder({}, categories={"lang": {v: k for k, v in enumerate(("de", "en", "es", "fr"))}})
    hot = F.transform(encoder.profile({"lang": F.col("lang")}), lambda x: x.cast("int").cast("string"))
    return read("documents").select("doc_id", F.array_join(hot, "").alias("lang_hot"))


@register(f"""
with q as (select embedding as e from embeddings order by vec_id limit 1)
select vec_id, {fixed_sql("list_cosine_similarity(embedding::double[], q.e::double[])", 6)} as cosine from embeddings, q
""")
def cosine_similarity(read) -> DataFrame:
    vectors = read("embeddings")
    first = vectors.agg(F.min_by("embedding", "vec_id")).first()[0] or []
    one = F.array(*[F.lit(float(x)) for x in first]).cast("array<double>")
    return vectors.select("vec_id", fixed(features.cosine(F.col("embedding"), one), 6).alias("cosine"))


@register("select event_id, k as place, event_id * 10 + k as vid, user_id as aid, (event_id + k) % 2 as label from events, unnest([0, 1, 2]) as t(k)")
def video_explode(read) -> DataFrame:
    entry = lambda k: F.concat_ws(":", (F.col("event_id") * 10 + k).cast("string"), F.col("user_id").cast("string"), ((F.col("event_id") + k) % 2).cast("string"))
    rows = read("events").select("event_id", F.concat_ws(",", entry(0), entry(1), F.lit("bad:x"), entry(2)).alias("videos"))
    return rows.select("event_id", F.posexplode(impressions(F.col("videos"))).alias("place", "v")).select("event_id", "place", "v.vid", "v.aid", "v.label")


# Identifiers, cells and maps.


@register("select c_custkey, case when length(x) = 32 then x else md5(x) end as id from (select c_custkey, case when c_custkey % 3 = 0 then md5(c_name) else c_name end as x from customer)")
def md5_userid(read) -> DataFrame:
    raw = F.when(F.col("c_custkey") % 3 == 0, F.md5("c_name")).otherwise(F.col("c_name"))
    return read("customer").select("c_custkey", md5_id(raw).alias("id"))


@register("""
with c as (select c_custkey, case when c_custkey % 4 = 0 then md5(c_name) else 'short' end as simei, '  ' || c_name || ' ' as aid, c_custkey % 3 as oem from customer)
select c_custkey, case when length(simei) = 32 then simei when oem = 2 then aid else md5(trim(lower(aid))) end as id from c
""")
def combine_userid(read) -> DataFrame:
    simei = F.when(F.col("c_custkey") % 4 == 0, F.md5("c_name")).otherwise("short")
    return read("customer").select("c_custkey", combined_id(simei, F.concat(F.lit("  "), "c_name", F.lit(" ")), F.col("c_custkey") % 3).alias("id"))


@register("""
with c as (select c_custkey::varchar as rowkey, [struct_pack(q := 'c_name', v := c_name), struct_pack(q := 'c_nationkey', v := case when c_nationkey <> 0 then c_nationkey::varchar end), struct_pack(q := 'c_mktsegment', v := c_mktsegment)] as cells from customer)
select rowkey, 't' as cf, s.q as qualifier, s.v as value from (select rowkey, unnest(cells) as s from c) where s.v is not null and s.v <> ''
""")
def kv_long_sink(read) -> DataFrame:
    return to_long_form(read("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), "c_custkey")


@register("select c_custkey::varchar as userid, c_name, c_mktsegment from customer")
def kv_long_read(read) -> DataFrame:
    long = to_long_form(read("customer").select("c_custkey", "c_name", "c_mktsegment"), "c_custkey")
    return from_long_form(long, ["c_name", "c_mktsegment"])


@register("select user_id, event_type, count(*)::bigint as n from events group by 1, 2")
def map_merge(read) -> DataFrame:
    days = read("events").groupBy("user_id", F.to_date("ts").alias("d"), "event_type").agg(F.count(F.lit(1)).alias("n")).groupBy("user_id", "d").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("counts"))
    return sum_maps(days, "user_id", "counts").select("user_id", F.explode("counts").alias("event_type", "n"))


@register("select c_custkey, c_name as name from customer")
def des_round_trip(read) -> DataFrame:
    key = b"8bytekey"
    return read("customer").select("c_custkey", des_decrypt(des_encrypt(F.col("c_name"), key), key).alias("name"))


# Places. Coordinates are made from keys.

_POINT = "(73.0 + (c_custkey * 37 % 6300) / 100.0)::double as lng, (3.5 + (c_custkey * 53 % 5100) / 100.0)::double as lat"


def _points(read) -> DataFrame:
    k = F.col("c_custkey")
    return read("customer").select(k, (F.lit(73.0) + (k * 37 % 6300) / 100.0).alias("lng"), (F.lit(3.5) + (k * 53 % 5100) / 100.0).alias("lat"))


def _series_sql(angle: str, terms: tuple) -> str:
    return "(" + " + ".join(f"{a} * sin(({angle}) * ({m!r} * pi() / {d!r}))" for a, m, d in terms) + ") * (2.0::double / 3.0)"


_GCJ = "x - 0.0065 as gx, y - 0.006 as gy"
_GCJ_SQL = "(sqrt(gx * gx + gy * gy) - 0.00002 * sin(gy * pi() * 3000.0 / 180.0))"
_THETA_SQL = "(atan2(gy, gx) - 0.000003 * cos(gx * pi() * 3000.0 / 180.0))"


def _wgs_sql(source: str) -> str:
    """A select of (c_custkey, lng, lat, wlng, wlat) from rows of (c_custkey, lng, lat)."""
    return f"""(select c_custkey, lng, lat, case when inside then lng - degrees(dlng / ({geo.AXIS} / sqrt(w) * cos(radians(lat)))) else lng end as wlng, case when inside then lat - degrees(dlat / ({geo.AXIS * (1 - geo.ECCENTRICITY)!r} / (w * sqrt(w)))) else lat end as wlat from (
  select *, 1.0 - {geo.ECCENTRICITY!r} * sin(radians(lat)) * sin(radians(lat)) as w, lng > 73.66 and lng < 135.05 and lat > 3.86 and lat < 53.55 as inside,
  300.0 + a + 2.0 * b + 0.1 * a * a + 0.1 * a * b + 0.1 * sqrt(abs(a)) + {_series_sql("a", geo.SHIFT_COMMON)} + {_series_sql("a", geo.SHIFT_LNG)} as dlng,
  -100.0 + 2.0 * a + 3.0 * b + 0.2 * b * b + 0.1 * a * b + 0.2 * sqrt(abs(a)) + {_series_sql("a", geo.SHIFT_COMMON)} + {_series_sql("b", geo.SHIFT_LAT)} as dlat
  from (select *, lng - 105.0 as a, lat - 35.0 as b from {source})))"""


@register(f"select c_custkey, {fixed_sql('wlng', 5)} as lng, {fixed_sql('wlat', 5)} as lat, not (p.lng > 73.66 and p.lng < 135.05 and p.lat > 3.86 and p.lat < 53.55) as outside from {_wgs_sql(f'(select c_custkey, {_POINT} from customer)')} p")
def geo_gcj_to_wgs(read) -> DataFrame:
    lng, lat = geo.gcj02_to_wgs84(F.col("lng"), F.col("lat"))
    return _points(read).select("c_custkey", fixed(lng, 5).alias("lng"), fixed(lat, 5).alias("lat"), geo.out_of_china(F.col("lng"), F.col("lat")).alias("outside"))


def _band_sql(k: int) -> str:
    c = geo.COEFFICIENTS[k]
    d = f"(abs(my) / {c[9]!r}::double)"
    poly = " + ".join([f"({c[2]!r}::double)", *[f"({c[n + 2]!r}::double) * pow({d}, {n})" for n in range(1, 7)]])
    return f"when abs(my) >= {geo.BANDS[k]!r} then struct_pack(x := round_even({c[0]!r}::double + {c[1]!r}::double * abs(mx), 6), y := round_even({poly}, 6))"


MERCATOR_SQL = f"""
with m as (select c_custkey, (8000000.0 + (c_custkey * 7919 % 700000) * 10)::double as mx, ((c_custkey * 104729 % 1300000) * 10)::double as my from customer),
b as (select c_custkey, s.x, s.y from (select c_custkey, case {" ".join(_band_sql(k) for k in range(6))} end as s from m)),
g as (select c_custkey, x, y, {_GCJ_SQL} * cos({_THETA_SQL}) as lng, {_GCJ_SQL} * sin({_THETA_SQL}) as lat from (select *, {_GCJ} from b)),
w as (select * from {_wgs_sql("g")})
"""
COORDINATES = f"""{fixed_sql("x")} as bd_lng, {fixed_sql("y")} as bd_lat, {fixed_sql("lng")} as gcj_lng, {fixed_sql("lat")} as gcj_lat, {fixed_sql("wlng")} as wgs_lng, {fixed_sql("wlat")} as wgs_lat"""


@register(f"{MERCATOR_SQL} select b.c_custkey, {COORDINATES} from b join w using (c_custkey)")
def geo_mercator(read) -> DataFrame:
    k = F.col("c_custkey")
    metres = read("customer").select(k, (F.lit(8000000.0) + (k * 7919 % 700000) * 10).cast("double").alias("lng"), ((k * 104729 % 1300000) * 10).cast("double").alias("lat"))
    found = metres
    for name, step in (("bd", geo.mercator_to_bd09), ("gcj", geo.bd09_to_gcj02), ("wgs", geo.gcj02_to_wgs84)):
        found = geo.convert(found, step).withColumns({f"{name}_lng": fixed(F.col("lng")), f"{name}_lat": fixed(F.col("lat"))})
    return found.drop("lng", "lat")


@register(f"""
with p as (select c_custkey, {_POINT} from customer), h as (select *, pow(sin((radians(lat) - radians(39.9)) / 2), 2) + cos(radians(lat)) * cos(radians(39.9)) * pow(sin((radians(lng) - radians(116.4)) / 2), 2) as h from p)
select c_custkey, {fixed_sql(f"2 * {geo.RADIUS} * asin(sqrt(h))", 2)} as metres, {fixed_sql(f"lng - degrees(2 * asin(sin(500.0 / {geo.RADIUS}) / cos(radians(lat))))")} as lng_min, {fixed_sql(f"lat + degrees(asin(2 * sin(500.0 / {geo.RADIUS})))")} as lat_max from h
""")
def geo_distance(read) -> DataFrame:
    box = geo.bounds(F.col("lng"), F.col("lat"), 1000.0)
    return _points(read).select("c_custkey", fixed(geo.haversine(F.col("lng"), F.col("lat"), F.lit(116.4), F.lit(39.9)), 2).alias("metres"), fixed(box["lng_min"]).alias("lng_min"), fixed(box["lat_max"]).alias("lat_max"))


def _plane_sql(lng: str, lat: str, metres: float) -> str:
    half = geo.math.sin(metres / 2 / geo.RADIUS)
    return f"round_even({lng} * ({geo.degrees_of(metres)!r}::double / (2 * degrees(asin({half!r}::double / cos(radians(round_even({lat}, 5))))))), 5)"


@register(f"""
with u as (select o_orderkey as aid, (100.0 + (o_orderkey * 7919 % 200000) / 10000.0)::double as lng, (30.0 + (o_orderkey * 104729 % 200000) / 10000.0)::double as lat from orders),
s as (select (100.0 + (s_suppkey * 3571 % 2000) / 100.0)::double as lng, (30.0 + (s_suppkey * 1237 % 2000) / 100.0)::double as lat from supplier),
a as (select aid, {_plane_sql("lng", "lat", 1000.0)} as x, round_even(lat, 5) as y from u), b as (select {_plane_sql("lng", "lat", 1000.0)} as x, round_even(lat, 5) as y from s)
select distinct aid from a join b on sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) <= {geo.degrees_of(30000.0)!r}::double
""")
def poi_within_radius(read) -> DataFrame:
    k, s = F.col("o_orderkey"), F.col("s_suppkey")
    record = lambda lng, lat: F.concat(F.lit("g:"), lng.cast("string"), F.lit(","), lat.cast("string"))
    packed = read("orders").select(k.alias("aid"), F.array(F.lit("bad"), record(F.lit(100.0) + (k * 7919 % 200000) / 10000.0, F.lit(30.0) + (k * 104729 % 200000) / 10000.0)).alias("geo"))
    users = packed.select("aid", first_geo(F.col("geo")).alias("g")).select("aid", "g.lng", "g.lat")
    places = read("supplier").select((F.lit(100.0) + (s * 3571 % 2000) / 100.0).alias("lng"), (F.lit(30.0) + (s * 1237 % 2000) / 100.0).alias("lat"))
    return within_radius(users, places, 30000.0)


@register(f"""
with u as (select o_orderkey as aid, (100.0 + (o_orderkey * 7919 % 200000) / 10000.0)::double as lng, (30.0 + (o_orderkey * 104729 % 200000) / 10000.0)::double as lat from orders),
s as (select (100.0 + (s_suppkey * 3571 % 2000) / 100.0)::double as lng, (30.0 + (s_suppkey * 1237 % 2000) / 100.0)::double as lat from supplier)
select distinct aid from u join s on 2 * {geo.RADIUS} * asin(sqrt(pow(sin((radians(u.lat) - radians(s.lat)) / 2), 2) + cos(radians(u.lat)) * cos(radians(s.lat)) * pow(sin((radians(u.lng) - radians(s.lng)) / 2), 2))) <= 30000.0
""")
def poi_within_radius_sphere(read) -> DataFrame:
    k, s = F.col("o_orderkey"), F.col("s_suppkey")
    users = read("orders").select(k.alias("aid"), (F.lit(100.0) + (k * 7919 % 200000) / 10000.0).alias("lng"), (F.lit(30.0) + (k * 104729 % 200000) / 10000.0).alias("lat"))
    places = read("supplier").select((F.lit(100.0) + (s * 3571 % 2000) / 100.0).alias("lng"), (F.lit(30.0) + (s * 1237 % 2000) / 100.0).alias("lat"))
    return within_radius(users, places, 30000.0, metric="haversine")


# IP ranges: one for each nation, with gaps.

_NAMES = ["北京市海淀区", "广西壮族自治区南宁市", "内蒙古呼和浩特市", "黑龙江省哈尔滨市", "广东省深圳市", "西藏拉萨市", "美国", "台湾省台北市"]


def _ranges(read) -> DataFrame:
    k = F.col("n_nationkey").cast("long")
    names = F.array(*[F.lit(x) for x in _NAMES])
    return read("nation").select((k * 160_000_000 + 1000).alias("ip_begin"), (k * 160_000_000 + 100_001_000).alias("ip_end"), names[(k % len(_NAMES)).cast("int")].alias("country"))


def _addresses(read) -> DataFrame:
    n = F.col("o_orderkey").cast("long") * 715_827 % 4_294_967_296
    octet = lambda s: F.shiftright(n, s).bitwiseAND(F.lit(255)).cast("string")
    return read("orders").select("o_orderkey", F.concat_ws(".", octet(24), octet(16), octet(8), octet(0)).alias("ip")).withColumn("number", ip_number(F.col("ip")))


_IN_LIST = lambda names: "(" + ", ".join(f"'{x}'" for x in names) + ")"
_IP_SQL = f"""
i as (select o_orderkey, o_orderkey * 715827 % 4294967296 as number from orders),
r as (select n_nationkey::bigint * 160000000 + 1000 as ip_begin, n_nationkey::bigint * 160000000 + 100001000 as ip_end, [{", ".join(f"'{x}'" for x in _NAMES)}][n_nationkey % {len(_NAMES)} + 1] as country from nation),
j as (select o_orderkey, number, ip_begin, case when number <= ip_end then country end as country from i asof left join r on i.number >= r.ip_begin)
"""


@register(f"with {_IP_SQL} select o_orderkey, number, case when country is not null then ip_begin end as ip_begin, country from j")
def ip_range_lookup(read) -> DataFrame:
    return range_lookup(_addresses(read), _ranges(read), "number").select("o_orderkey", "number", "ip_begin", "country")


@register(f"""
with {_IP_SQL}, c as (select o_orderkey, country, substr(country, 1, 2) as two, substr(country, 1, 3) as three, substr(country, 3) as rest2, substr(country, 4) as rest3 from j),
p as (select *, case when two in {_IN_LIST(MUNICIPALITIES)} then 1 when two in {_IN_LIST(REGIONS)} then 2 when three in {_IN_LIST(LONG_NAMES)} then 3 when two in {_IN_LIST(PROVINCES)} then 4 end as kind from c)
select o_orderkey, case kind when 3 then three when 1 then two when 2 then two when 4 then two end as province,
  case kind when 1 then two when 2 then rtrim(case when contains(rest2, '自治区') then substr(rest2, strpos(rest2, '自治区') + 3) else rest2 end, '市') when 3 then rtrim(rest3, '市') when 4 then rtrim(ltrim(rest2, '省'), '市') end as city from p
""")
def ip_city(read) -> DataFrame:
    found = range_lookup(_addresses(read), _ranges(read), "number").withColumn("c", province_city(F.col("country")))
    return found.select("o_orderkey", "c.province", "c.city")


@register(f"select max(n_nationkey::bigint * 160000000 + 1000) as ip_begin, [{', '.join(f"'{x}'" for x in _NAMES)}][max(n_nationkey) % {len(_NAMES)} + 1] as country from nation")
def ip_last_range(read) -> DataFrame:
    return _ranges(read).agg(F.max_by(F.struct("ip_begin", "country"), "ip_begin").alias("r")).select("r.ip_begin", "r.country")


@register("""
with p as (select p_partkey, 'word' || (p_partkey % 50) as search_word, p_partkey % 4 as k, p_size from part),
f as (select *, k = 0 and p_size % 5 = 0 as first, p_size % 7 = 1 as second from p), a as (select *, bool_or(first) over (partition by search_word) as any_first from f)
select p_partkey from a where first or (second and not any_first)
""")
def college_filter(read) -> DataFrame:
    word = F.concat(F.lit("word"), (F.col("p_partkey") % 50).cast("string"))
    places = read("part").select("p_partkey", word.alias("search_word"), word.alias("name"), F.when((F.col("p_partkey") % 4 == 0) & (F.col("p_size") % 5 == 0), "教育培训;高等院校").alias("std_tag"), F.lit(None).cast("string").alias("di_tag"), F.when(F.col("p_size") % 7 == 1, "bus").alias("cp"))
    return college_places(places).select("p_partkey")


# Evaluation: a score made of the identifier, and quality as label.


def _scored(read) -> DataFrame:
    score = (F.col("doc_id") * 7919 % 1000) / 1000.0
    return read("labels").select("doc_id", F.col("quality").alias("label"), score.alias("score"), F.when(score > 0.5, 1).otherwise(0).alias("prediction"))


_SCORED = "s as (select doc_id, quality as label, (doc_id * 7919 % 1000) / 1000.0::double as score, (case when (doc_id * 7919 % 1000) / 1000.0::double > 0.5 then 1 else 0 end)::int as prediction from labels)"


@register(f"with {_SCORED} select label, prediction, count(*) as n, {fixed_sql('count(*) / sum(count(*)) over (partition by label)', 6)} as share from s group by label, prediction")
def confusion(read) -> DataFrame:
    return evaluation.confusion(_scored(read)).withColumn("share", fixed(F.col("share"), 6))


@register(f"""
with {_SCORED}, r as (select label, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2.0 as rank from s where label is not null)
select {fixed_sql("(sum(rank) filter (label > 0) - count(*) filter (label > 0) * (count(*) filter (label > 0) + 1) / 2.0) / ((count(*) filter (label > 0))::double * count(*) filter (label <= 0))", 9)} as auc, count(*) filter (label > 0) as positives, count(*) filter (label <= 0) as negatives from r
""")
def auc_rank(read) -> DataFrame:
    return evaluation.rank_auc(_scored(read)).withColumn("auc", fixed(F.col("auc"), 9))


_BINS = f"{_SCORED}, e as (select min(score) as low, max(score) as high from s), b as (select least(floor((score - low) / (high - low) * 100), 99)::int as bin, label from s, e where label is not null), c as (select bin, count(*) filter (label > 0) as p, count(*) filter (label <= 0) as n from b group by bin)"


@register(f"with {_BINS}, x as (select *, sum(n) over (order by bin) - n as below from c) select {fixed_sql('sum(p * (below + n / 2.0))::double / (sum(p)::double * sum(n))', 9)} as auc from x")
def auc_binned(read) -> DataFrame:
    return evaluation.binned_auc(_scored(read), 100).select(fixed(F.col("auc"), 9).alias("auc"))


@register(f"with {_BINS} select bin, {fixed_sql('sum(p) over (order by bin desc) / sum(p) over ()', 6)} as tpr, {fixed_sql('sum(n) over (order by bin desc) / sum(n) over ()', 6)} as fpr from c")
def roc_binned(read) -> DataFrame:
    return evaluation.roc(_scored(read), 100).select("bin", fixed(F.col("tpr"), 6).alias("tpr"), fixed(F.col("fpr"), 6).alias("fpr"))


@register()
def stacking_predict(read) -> DataFrame:
    rows = read("embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"), (F.col("label") >= 5).cast("double").alias("label"))
    model = StackingClassifier([sparse_logistic(regParam=0.01), boosted_trees(maxIter=5, maxDepth=3, stepSize=0.3)], sparse_logistic(regParam=0.01)).fit(rows)
    return model.transform(rows).select("vec_id", "prediction", "prob")


from tallymark.plans import catalog_files, catalog_models  # noqa: E402, F401  register more queries
