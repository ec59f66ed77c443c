"""Registered queries that write with each sink and read with the matching source, and the jobs around them."""

from __future__ import annotations

import json
import os
import tempfile

from pyarrow import fs
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions import geo
from tallymark.functions.des import des_encrypt
from tallymark.functions.ids import cell_values
from tallymark.operators import evaluation, tagging
from tallymark.operators.lookups import city_centres, range_lookup
from tallymark.operators.polygons import with_city, with_shapes
from tallymark.operators.rules import once
from tallymark.plans.catalog import _IP_SQL, COORDINATES, MERCATOR_SQL, _addresses, _event_rows, _ranges, _scored, fixed, fixed_sql, register
from tallymark.session import shared_path
from tallymark.sources import ip_ranges, readers, writers


def _dictionary(frame: DataFrame, size: int = 100_000) -> list:
    """The rows of a dictionary that a driver holds; a larger table is an error."""
    rows = frame.limit(size + 1).collect()
    if len(rows) > size:
        raise ValueError(f"more than {size} rows for a dictionary")
    return rows


def _put(path: str, data: bytes) -> str:
    """A small file in the shared folder."""
    system, name = fs.FileSystem.from_uri(path)
    system.create_dir(os.path.dirname(name), recursive=True)
    with system.open_output_stream(name, compression=None) as file:
        file.write(data)
    return path


# Sources and sinks.


@register("select n_nationkey, n_name from nation where n_regionkey = 1")
def table_scan(read) -> DataFrame:
    nation = read("nation")
    nation.createOrReplaceTempView("tallymark_nation")
    return readers.table(nation.sparkSession, "tallymark_nation", ["n_nationkey", "n_name"], "n_regionkey = 1")


@register("select n_nationkey, n_name, n_regionkey from nation")
def orc_round_trip(read) -> DataFrame:
    nation = read("nation").select("n_nationkey", "n_name", "n_regionkey")
    path = shared_path(nation.sparkSession, "orc")
    writers.orc(nation, path, files=3)
    return readers.orc(nation.sparkSession, path)


@register(f"select vec_id, {fixed_sql('list_sum(embedding::double[])', 6)} as total from embeddings")
def orc_vectors(read) -> DataFrame:
    vectors = read("embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    path = shared_path(vectors.sparkSession, "orc-vectors")
    writers.orc(vectors, path, rows_per_file=100)
    found = readers.orc(vectors.sparkSession, path, vectors.schema)
    return found.select("vec_id", fixed(F.aggregate(vector_to_array("v"), F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


@register("select s_suppkey, s_name, s_acctbal from supplier")
def csv_with_header(read) -> DataFrame:
    supplier = read("supplier").select("s_suppkey", "s_name", "s_acctbal")
    path = shared_path(supplier.sparkSession, "csv")
    supplier.write.option("header", True).csv(path)
    return readers.csv(supplier.sparkSession, path, "s_suppkey bigint, s_name string, s_acctbal double")


@register("select distinct o_orderpriority as value from orders")
def text_distinct(read) -> DataFrame:
    orders = read("orders")
    path = shared_path(orders.sparkSession, "text")
    writers.text(orders, "o_orderpriority", path)
    return readers.text(orders.sparkSession, path)


@register("select n_name as key, max(n_nationkey::varchar) as value from nation group by n_name")
def key_value_text(read) -> DataFrame:
    nation = read("nation")
    path = shared_path(nation.sparkSession, "pairs")
    lines = nation.select(F.concat("n_name", F.lit("\t"), F.col("n_nationkey").cast("string")).alias("value")).union(nation.select(F.concat("n_name", F.lit("\tthree\tfields")).alias("value")))
    lines.write.text(path)
    return readers.key_values(nation.sparkSession, path)


@register("select count(*) as n, sum(n_nationkey)::bigint as total from nation")
def key_value_dictionary(read) -> DataFrame:
    """The map on the driver, and the same pairs through a local file."""
    nation = read("nation")
    spark = nation.sparkSession
    path = shared_path(spark, "pairs")
    nation.select(F.concat("n_name", F.lit("="), F.col("n_nationkey").cast("string")).alias("value")).write.text(path)
    found = readers.key_value_map(spark, path, "=")
    with tempfile.TemporaryDirectory() as folder:  # a local dump by definition: written and read by the driver
        n = writers.lines(nation.select(F.concat("n_name", F.lit("="), F.col("n_nationkey").cast("string")).alias("value")), "value", f"{folder}/pairs")
        if readers.local_map(f"{folder}/pairs", "=") != found:
            raise ValueError("the local file and the map differ")
    return spark.createDataFrame([(n, sum(map(int, found.values())))], "n long, total long")


@register("select n_name as token, (row_number() over (order by n_name) - 1)::int as id from nation")
def vocabulary_lines(read) -> DataFrame:
    """A vocabulary file that an executor writes, numbered by its lines."""
    nation = read("nation")
    path = shared_path(nation.sparkSession, "vocabulary")
    nation.select(F.concat(F.lit(" "), "n_name", F.lit(" ")).alias("value")).coalesce(1).sortWithinPartitions("value").write.text(path)
    return readers.numbered_lines(nation.sparkSession, path)


@register("select r_regionkey, exists(select 1 from nation where n_regionkey = r_regionkey) as there from region")
def path_exists(read) -> DataFrame:
    """Which regions have a folder in a table written by region."""
    region, nation = read("region"), read("nation")
    spark = region.sparkSession
    path = shared_path(spark, "by-region")
    writers.parquet(nation, path, ["n_regionkey"])
    found = [(r.r_regionkey, readers.exists(spark, f"{path}/n_regionkey={r.r_regionkey}")) for r in _dictionary(region.select("r_regionkey"))]
    return spark.createDataFrame(found, "r_regionkey long, there boolean")


@register("select n_regionkey, count(*) as n from nation group by n_regionkey")
def parquet_partitioned(read) -> DataFrame:
    nation = read("nation")
    path = shared_path(nation.sparkSession, "partitioned")
    writers.parquet(nation, path, ["n_regionkey"])
    return nation.sparkSession.read.parquet(path).groupBy(F.col("n_regionkey").cast("long").alias("n_regionkey")).agg(F.count(F.lit(1)).alias("n"))


@register("select c_custkey::varchar as rowkey, 't' as cf, 'c_name' as qualifier, c_name as value from customer where c_name <> ''")
def long_form_file(read) -> DataFrame:
    customer = read("customer").select("c_custkey", "c_name")
    path = shared_path(customer.sparkSession, "cells")
    writers.long_form(customer, "c_custkey", path)
    return customer.sparkSession.read.parquet(path)


@register("select doc_id, score from (select doc_id, (doc_id * 7919 % 1000) / 1000.0::double as score from labels) where score > 0.25")
def threshold_sink(read) -> DataFrame:
    return writers.above(_scored(read).select("doc_id", "score"), 0.25, "score")


@register("select c_custkey, k, 'v' || (c_custkey + k) as v from customer, unnest([0, 1]) as t(k)")
def json_cells(read) -> DataFrame:
    """Cells of JSON lines, one of which does not parse."""
    k = F.col("c_custkey")
    line = lambda n: F.to_json(F.struct(F.lit(n).alias("k"), F.concat(F.lit("v"), (k + n).cast("string")).alias("v")))
    cells = read("customer").select("c_custkey", F.concat_ws("\n", line(0), F.lit("{no json"), line(1)).alias("cell"))
    found = cells.select("c_custkey", F.explode(cell_values(F.col("cell"), "k int, v string")).alias("x"))
    return found.select("c_custkey", "x.k", "x.v").where("k is not null")


# Filters and rows.


@register("select doc_id from labels where quality = 1 and toxic is not null")
def labelled_rows(read) -> DataFrame:
    return read("labels").where(F.col("toxic").isNotNull()).where(F.col("quality").cast("double") == 1.0).select("doc_id")


@register("select c_custkey as id, c_name as name, 1 as part from customer union all select s_suppkey, s_name, 2 from supplier")
def union_all(read) -> DataFrame:
    a = read("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit(1).alias("part"))
    return a.unionByName(read("supplier").select(F.lit(2).alias("part"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")))


@register("select distinct user_id, 1::bigint as partitions from events")
def repartition_by_device(read) -> DataFrame:
    dealt = read("events").repartition("user_id").select("user_id", F.spark_partition_id().alias("p"))
    return dealt.groupBy("user_id").agg(F.count_distinct("p").alias("partitions"))


# The electronic codebook example of the federal standard on modes of operation, by block.
_DES_KEY = "0123456789ABCDEF"
_DES_PLAIN = ["Now is t", "he time ", "for all "]
_DES_CIPHER = ["3FA40E8A984D4815", "6A271787AB8883F9", "893D51EC4B563B53"]


def _by_digits(blocks: list[str]) -> str:
    """SQL of both engines: one of the blocks for each of three digits to base 3 of c_custkey."""
    return " || ".join(f"case cast(floor(c_custkey / {3**k}) as bigint) % 3 when 0 then '{blocks[0]}' when 1 then '{blocks[1]}' else '{blocks[2]}' end" for k in range(3))


@register(f"select c_custkey, {_by_digits(_DES_CIPHER)} as cipher from customer")
def des_published_vector(read) -> DataFrame:
    """Texts of published blocks in an order that each key gives, against the published cipher blocks; what follows is padding."""
    plain = read("customer").select("c_custkey", F.expr(_by_digits(_DES_PLAIN)).alias("plain"))
    return plain.select("c_custkey", F.upper(F.substring(des_encrypt(F.col("plain"), bytes.fromhex(_DES_KEY)), 1, 48)).alias("cipher"))


@register("with s as (select doc_id, quality as label, (case when (doc_id * 7919 % 1000) / 1000.0::double > 0.5 then 1 else 0 end)::int as prediction from labels) select floor(avg((label = prediction)::int) * 1000000.0 + 0.5)::bigint as accuracy, count(*) as n from s where label is not null")
def accuracy(read) -> DataFrame:
    return evaluation.accuracy(_scored(read)).select(fixed(F.col("accuracy"), 6).alias("accuracy"), "n")


# Tags as maps, and the command line.


@register("""
with e as (select user_id as userid, count(*) filter (event_type = 'click') as a, count(*) filter (event_type = 'signup') as b from events group by 1)
select userid, case when a > 0 then a::int end as clicks, case when b > 0 then b::int end as signups from e where a > 0 or b > 0
""")
def tags_as_map(read) -> DataFrame:
    rules = ["apps_freq=click", "apps_freq=signup"]
    tagged = tagging.user_tags(tagging.sub_scores(_event_rows(read), rules), rules)
    found = tagging.tag_map(tagged, ["clicks", "signups"])
    return found.select("userid", *[F.try_element_at("tags", F.lit(k)).alias(k) for k in ("clicks", "signups")])


@register("""
select user_id as userid, count(*) filter (event_type = 'click')::int as clicks from events where strftime(ts, '%Y%m%d') >= '20240102' group by 1 having count(*) filter (event_type = 'click') > 0
""")
def command_line_user_tags(read) -> DataFrame:
    from tallymark.plans import cli

    rows = _event_rows(read)
    spark = rows.sparkSession
    lines, out = shared_path(spark, "cli-lines"), shared_path(spark, "cli-tags")
    rows.write.parquet(lines)
    cli.main(["user_tags", out, json.dumps(["clicks"]), json.dumps(["apps_freq=click"]), "--lines", lines, "--start_date", "20240102", "--mode", "user"])
    return spark.read.parquet(out).select("userid", F.element_at("tags", "clicks").alias("clicks"))


# The address dictionary from its file to cities.


@register(f"""
with {_IP_SQL} select o_orderkey, ip_begin, country from (select o_orderkey, case when country is not null then ip_begin end as ip_begin, country from j)
""")
def ip_dictionary_file(read) -> DataFrame:
    """A masked and packed dictionary is decoded, written, read by its source and looked up."""
    import zlib

    ranges = _ranges(read)
    spark = ranges.sparkSession
    rows = sorted((r.ip_begin, r.ip_end, r.country, "area") for r in _dictionary(ranges))
    packed, state, head = zlib.compress(ip_ranges.build(rows)), 77, bytearray()
    for byte in packed[:0x200]:
        state = (state * 0x805 + 1) & 0xFF
        head.append(byte ^ state)
    path = _put(f"{shared_path(spark, 'ip')}/ranges.dat", ip_ranges.decode_download(77, bytes(head) + packed[0x200:]))
    spark.dataSource.register(ip_ranges.IpRangeSource)
    dictionary = spark.read.format("ip_ranges").load(path)
    return range_lookup(_addresses(read), dictionary, "number").select("o_orderkey", "ip_begin", "country")


# Cities of points: squares around centres that are made from keys.

_CENTRE = "(80.0 + (n_nationkey % 5) * 8.0)::double as clng, (10.0 + (n_nationkey // 5) * 7.0)::double as clat"


def _districts(spark, nation: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The districts' file and the shapes as frames: shapes from a folder of GeoJSON: a square of six degrees around each centre."""
    rows = [(r.n_name, 80.0 + (r.n_nationkey % 5) * 8.0, 10.0 + (r.n_nationkey // 5) * 7.0) for r in _dictionary(nation.orderBy("n_nationkey"))]
    centre = lambda x, y: {"longitude": x, "latitude": y}
    whole = {"districts": [{"name": "P", "center": centre(0.0, 0.0), "districts": [{"name": f"市{name}市", "center": centre(x, y)} for name, x, y in rows]}]}
    folder = shared_path(spark, "places")
    path = _put(f"{folder}/region.json", json.dumps(whole).encode())
    for k in range(0, len(rows), 10):
        features = [{"type": "Feature", "properties": {"name": name}, "geometry": {"type": "Polygon", "coordinates": [[[x - 3, y - 3], [x + 3, y - 3], [x + 3, y + 3], [x - 3, y + 3], [x - 3, y - 3]]]}} for name, x, y in rows[k : k + 10]]
        _put(f"{folder}/shapes/{k}.json", json.dumps([{"type": "FeatureCollection", "features": features}]).encode())
    schema = "districts array<struct<name:string,center:struct<longitude:double,latitude:double>,districts:array<struct<name:string,center:struct<longitude:double,latitude:double>>>>>"
    return spark.read.schema(schema).option("multiLine", True).json(path), readers.geojson_polygons(spark, f"{folder}/shapes")


@register(f"select 'P' as province, n_name as city, clng as lng, clat as lat from (select n_name, {_CENTRE} from nation)")
def city_centre_table(read) -> DataFrame:
    nation = read("nation")
    return city_centres(_districts(nation.sparkSession, nation)[0])


@register(f"""
with p as (select c_custkey, (70.05 + (c_custkey * 37 % 6900) / 100.0)::double as lng, (2.03 + (c_custkey * 53 % 5300) / 100.0)::double as lat from customer),
c as (select n_name, {_CENTRE}, n_nationkey from nation),
d as (select c_custkey, lng, lat, n_name, abs(lng - clng) < 3 and abs(lat - clat) < 3 as inside, row_number() over (partition by c_custkey order by (lng - clng) * (lng - clng) + (lat - clat) * (lat - clat), n_nationkey) as nth from p, c)
select c_custkey, case when not (any_value(lng) between 73.5 and 135 and any_value(lat) between 4 and 53.5) then 'foreign' else coalesce(min_by(n_name, nth) filter (inside and nth <= 3), min_by(n_name, nth)) end as city from d group by c_custkey
""")
def city_of_point(read) -> DataFrame:
    customer, nation = read("customer"), read("nation")
    spark = nation.sparkSession
    districts, shapes = _districts(spark, nation)
    centres = {r.city: (r.lng, r.lat) for r in _dictionary(city_centres(districts))}
    k = F.col("c_custkey")
    points = customer.select(k, (F.lit(70.05) + (k * 37 % 6900) / 100.0).alias("lng"), (F.lit(2.03) + (k * 53 % 5300) / 100.0).alias("lat"))
    return with_city(points, "lng", "lat", centres, shapes).select("c_custkey", "city")


@register("""
with p as (select c_custkey, (70.055 + (c_custkey * 37 % 6900) / 100.0)::double as x, (2.035 + (c_custkey * 53 % 5300) / 100.0)::double as y from customer),
s as (select n_nationkey, 80.0 + (n_nationkey % 5) * 8.0 as cx, 10.0 + (n_nationkey // 5) * 7.0 as cy from nation),
h as (select c_custkey, n_nationkey from p, s where greatest(abs(x - cx), abs(y - cy)) < 3 and greatest(abs(x - cx), abs(y - cy)) > 1.015 or abs(x - cx - 4) + abs(y - cy) < 1)
select c_custkey, count(n_nationkey)::int as n_shapes, coalesce(sum(n_nationkey), 0)::bigint as keys from p left join h using (c_custkey) group by c_custkey
""")
def points_in_polygons(read) -> DataFrame:
    """Polygons of two parts, a square with a hole and a diamond that may lie over a neighbour, from the nations' keys."""
    k, n = F.col("c_custkey"), F.col("n_nationkey")
    points = read("customer").select(k, (F.lit(70.055) + (k * 37 % 6900) / 100.0).alias("lng"), (F.lit(2.035) + (k * 53 % 5300) / 100.0).alias("lat"))
    x, y = 80.0 + (n % 5) * 8.0, 10.0 + F.floor(n / 5) * 7.0
    ring = lambda at: F.array(*[F.struct((x + a).alias("x"), (y + b).alias("y")) for a, b in at])
    square = lambda r: ring([(-r, -r), (r, -r), (r, r), (-r, r), (-r, -r)])
    holed, diamond = F.array(square(3), square(1.015)), F.array(ring([(3, 0), (4, 1), (5, 0), (4, -1)]))
    shapes = read("nation").select(n.cast("string").alias("name"), F.posexplode(F.array(holed, diamond)).alias("part", "rings"))
    return with_shapes(points, "lng", "lat", shapes).select("c_custkey", F.size("shapes").alias("n_shapes"), F.aggregate("shapes", F.lit(0).cast("long"), lambda a, s: a + s.cast("long")).alias("keys"))


@register("select count(*) as n, count(distinct n_name) as names from nation")
def district_dictionary(read) -> DataFrame:
    """The districts as a dictionary on the driver, from a local file."""
    nation = read("nation")
    with tempfile.TemporaryDirectory() as folder:
        writers.lines(nation.select(F.concat(F.lit('{"name": "'), "n_name", F.lit('"}')).alias("value")), "value", f"{folder}/lines")
        whole = "[" + ",".join(open(f"{folder}/lines", encoding="utf8").read().splitlines()) + "]"
        with open(f"{folder}/all.json", "w", encoding="utf8") as file:
            file.write(whole)
        found = readers.json_dictionary(f"{folder}/all.json")
    return nation.sparkSession.createDataFrame([(len(found), len({x["name"] for x in found}))], "n long, names long")


@register(f"""
{MERCATOR_SQL} select c.c_custkey, c_name as name, case c.c_custkey % 3 when 0 then '' when 1 then 'a1' else 'a1;a2' end as alias, case when c.c_custkey % 2 = 0 then 'tag' else '' end as tag, 9 as fields, {COORDINATES} from customer c join b using (c_custkey) join w using (c_custkey)
""")
def poi_rows(read) -> DataFrame:
    k = F.col("c_custkey")
    alias = F.when(k % 3 == 1, F.array(F.lit("a1"))).when(k % 3 == 2, F.array(F.lit("a1"), F.lit("a2")))
    x, y = F.lit(800000000) + (k * 7919 % 700000) * 1000, (k * 104729 % 1300000) * 1000
    rows = once(read("customer").select(k, "c_name"), "p", F.split(geo.poi_row(F.col("c_name"), x, y, alias, F.when(k % 2 == 0, "tag")), ","))
    numbers = [fixed(F.col("p")[k + 1].cast("double")).alias(c) for k, c in enumerate(("bd_lng", "bd_lat", "gcj_lng", "gcj_lat", "wgs_lng", "wgs_lat"))]
    return rows.select("c_custkey", *numbers, F.col("p")[0].alias("name"), F.col("p")[7].alias("alias"), F.col("p")[8].alias("tag"), F.size("p").alias("fields"))
