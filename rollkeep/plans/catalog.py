"""Registered queries: each applies an operator to whole tables that stand for its input.

QUERIES maps a name to its function, SQL to text that gives the same rows in ANSI SQL.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollkeep import schemas
from rollkeep.functions import scalar
from rollkeep.operators import compare, counts, dedup, resolve, scope, search, shape, versions
from rollkeep.plans import cycle
from rollkeep.sources import chunks, files, index, mapping, xml
from rollkeep.sources.scratch import shared_folder, stored
from rollkeep.sources.store import Store
from rollkeep.streaming import ingest, watch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (read, spark) under its name, with its SQL."""

    def add(make: Callable) -> Callable:
        name = make.__name__
        QUERIES[name] = lambda spark, folder: make(lambda table: spark.read.parquet(f"{folder}/{table}.parquet"), spark)
        if sql:
            SQL[name] = sql
        return make

    return add


def text(column: str) -> Column:
    return F.col(column).cast("string")


def dealt(rows: DataFrame, key: str) -> DataFrame:
    """rows dealt by a key over all tasks: a table of few bytes is read by one, which then does all the work on it."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def spread(rows: DataFrame, many: str, *others: str) -> DataFrame:
    """rows of others and one element of the array `many` at a time, under its own name. Spark guards a plain explode by a filter that makes the array, and all that it is parsed from, a second time."""
    return rows.select(*others, F.explode_outer(many).alias(many)).where(F.col(many).isNotNull())


# --- parties in scope ---------------------------------------------------------------------------

PARTIES_SQL = """
parties as (select c_mktsegment as snapshot_id, c_custkey as pos, cast(c_custkey as varchar) as fixed_ref,
  case when c_custkey % 97 = 0 then null when c_custkey % 89 = 0 then ' ' else cast(c_nationkey % 6 as varchar) end as sub from customer),
classified as (select *, case sub when '1' then 'Vessel' when '2' then 'Aircraft' when '3' then 'Entity' when '4' then 'Individual' else 'Unrecognized' end as party_class from parties)
"""


def parties(read) -> DataFrame:
    key = F.col("c_custkey")
    sub = F.when(key % 97 == 0, None).when(key % 89 == 0, " ").otherwise((F.col("c_nationkey") % 6).cast("string"))
    return read("customer").select(F.col("c_mktsegment").alias("snapshot_id"), key.alias("pos"), text("c_custkey").alias("fixed_ref"), sub.alias("party_sub_type_id"))


@query(f"with {PARTIES_SQL} select fixed_ref, party_class, case when party_class in ('Individual', 'Entity') then party_class end as entity_type from classified")
def scope_classify(read, spark):
    return scope.classified(parties(read)).select("fixed_ref", "party_class", "entity_type")


@query(f"with {PARTIES_SQL} select fixed_ref, party_class as entity_type from classified where party_class in ('Individual', 'Entity')")
def scope_filter(read, spark):
    return scope.in_scope(parties(read)).select("fixed_ref", "entity_type")


@query(f"with {PARTIES_SQL} select snapshot_id, count(*) as record_count, count(*) filter (party_class in ('Individual', 'Entity')) as in_scope_count, count(*) filter (party_class not in ('Individual', 'Entity')) as out_of_scope_count from classified group by 1")
def scope_counts(read, spark):
    return scope.scope_counts(parties(read))


@query(f"""with {PARTIES_SQL} select snapshot_id, fixed_ref, 'UNRECOGNIZED_TYPE' as kind,
  'party sub-type ' || case when sub is null then '<missing>' when trim(sub) = '' then '<empty>' else '''' || sub || '''' end as detail from classified where party_class = 'Unrecognized'""")
def scope_diagnostics(read, spark):
    return scope.scope_diagnostics(parties(read))


@query(f"with {PARTIES_SQL} select 'UNRECOGNIZED_TYPE' as kind, count(*) as n from classified where party_class = 'Unrecognized'")
def diagnostic_counts(read, spark):
    return compare.diagnostic_counts(scope.scope_diagnostics(parties(read)))


# --- XML ----------------------------------------------------------------------------------------


def element(name: str, attributes: dict[str, Column], *content) -> Column:
    """An XML element as text."""
    parts = [F.lit(f"<{name}")] + [p for k, v in attributes.items() for p in (F.lit(f' {k}="'), v, F.lit('"'))]
    return F.concat(*parts, F.lit(">"), *[c if isinstance(c, Column) else F.lit(c) for c in content], F.lit(f"</{name}>"))


def one_name(*parts: Column) -> Column:
    inner = [element("DocumentedNamePart", {}, element("NamePartValue", {"ScriptID": F.lit("215")}, p)) for p in parts]
    return element("DocumentedName", {}, *inner)


def party_fragments(read) -> DataFrame:
    """(pos, fragment): customers as party elements."""
    c = read("customer").join(read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    key = text("c_custkey")
    name = F.split("c_name", "#")
    aliases = [
        element("Alias", {"AliasTypeID": F.lit("1403"), "Primary": F.lit("false"), "LowQuality": F.lit("false")}, one_name(F.col("n_name"), F.lit(" "))),
        element("Alias", {"AliasTypeID": F.lit("1400"), "Primary": F.when(F.col("c_custkey") % 3 == 0, "false").otherwise("true"), "LowQuality": F.lit("true")}, one_name(F.concat(F.lit("  "), name[0]), name[1])),
        element("Alias", {"AliasTypeID": F.lit("1400"), "Primary": F.lit("false")}, one_name(F.lit(" "))),
    ]
    identity = element("Identity", {"ID": F.concat(F.lit("i"), key)}, *aliases)
    profile = element("Profile", {"ID": F.concat(F.lit("p"), key), "PartySubTypeID": (F.col("c_nationkey") % 6).cast("string")}, identity)
    return c.select(F.col("c_custkey").alias("pos"), element("DistinctParty", {"FixedRef": key}, "<Comment/>", profile).alias("fragment"))


def party_rows(read) -> DataFrame:
    rows = dealt(party_fragments(read), "pos").select("pos", xml.parse(F.col("fragment"), xml.PARTY).alias("x"))
    return rows.select(F.lit("s").alias("snapshot_id"), "pos", *xml.party_columns(F.col("x")))


@query("select cast(c_custkey as varchar) as fixed_ref, 'p' || c_custkey as profile_id, 'i' || c_custkey as identity_id, cast(c_nationkey % 6 as varchar) as party_sub_type_id, 2 as n_aliases from customer")
def xml_roundtrip(read, spark):
    return party_rows(read).select("fixed_ref", "profile_id", "identity_id", "party_sub_type_id", F.size("aliases").alias("n_aliases"))


@query("""select cast(c_custkey as varchar) as fixed_ref, case when c_custkey % 3 = 0 then n_name else 'Customer ' || split_part(c_name, '#', 2) end as primary_name,
  case when c_custkey % 3 = 0 then 'Customer ' || split_part(c_name, '#', 2) else n_name end as alias, case when c_custkey % 3 = 0 then 'WEAK' else 'STRONG' end as category,
  case when c_custkey % 3 = 0 then 'A.K.A.' end as alias_type, false as is_primary
from customer join nation on c_nationkey = n_nationkey""")
def xml_names(read, spark):
    labels = stored(spark.createDataFrame([("s", "AliasType", "1400", "A.K.A.")], "snapshot_id string, kind string, id string, label string"))  # of known size, so it goes to the names
    rows = stored(party_rows(read))  # read twice, parsed once
    named = resolve.resolve_names(rows, labels).join(rows.select("pos", "fixed_ref"), "pos")
    return named.select("fixed_ref", "primary_name", F.explode("aliases").alias("a")).select("fixed_ref", "primary_name", F.col("a.name").alias("alias"), F.col("a.category").alias("category"), F.col("a.type").alias("alias_type"), F.col("a.is_primary").alias("is_primary"))


@query("select cast(o_orderkey as varchar) as id, 'p' || o_custkey as profile_id, o_orderpriority as program from orders where o_orderkey % 5 <> 0")
def xml_programs(read, spark):
    blank = F.when(F.col("o_orderkey") % 5 == 0, "  ").otherwise(F.concat(F.lit(" "), "o_orderpriority", F.lit(" ")))
    measures = [element("SanctionsMeasure", {"SanctionsTypeID": F.lit(t)}, element("Comment", {}, c)) for t, c in (("2", F.col("o_orderstatus")), ("1", blank))]
    fragment = element("SanctionsEntry", {"ID": text("o_orderkey"), "ProfileID": F.concat(F.lit("p"), "o_custkey"), "ListID": F.lit("7")}, *measures)
    rows = dealt(read("orders"), "o_orderkey").select(xml.parse(fragment, xml.ENTRY).alias("x")).select(*xml.entry_columns(F.col("x")))
    return spread(rows, "programs", "id", "profile_id").withColumnRenamed("programs", "program")


@query("""select cast(n_nationkey as varchar) as location_id, cast(n_regionkey as varchar) as country_id, i.i as at, case i.i when 2 then null else 'T' || i.i end as part_type,
  case i.i when 0 then n_name when 1 then ' ' || r_name || ' ' else 'z' end as value from nation join region on n_regionkey = r_regionkey, (values (0), (1), (2)) as i(i)""")
def xml_locations(read, spark):
    rows = read("nation").join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    part = lambda attributes, *values: element("LocationPart", attributes, *[element("LocationPartValue", {}, element("Value", {}, v)) for v in values])
    fragment = element("Location", {"ID": text("n_nationkey")}, element("LocationCountry", {"CountryID": text("n_regionkey")}), part({"LocPartTypeID": F.lit("T0")}, F.col("n_name"), F.lit("  ")), part({"LocPartTypeID": F.lit("T1")}, F.concat(F.lit(" "), "r_name", F.lit(" "))), part({}, F.lit("z")))
    x = rows.select(xml.parse(fragment, xml.LOCATION).alias("x")).select(*xml.location_columns(F.col("x")))
    return x.select("location_id", "country_id", F.posexplode("parts").alias("at", "p")).select("location_id", "country_id", "at", F.col("p.loc_part_type_id").alias("part_type"), F.col("p.value").alias("value"))


@query("select cast(s_suppkey as varchar) as id, 'i' || s_nationkey as identity_id, '15' as type_id, case when s_suppkey % 4 <> 0 then s_name end as number, case when s_suppkey % 3 = 0 then 'issuer ' || s_nationkey end as issuer from supplier")
def xml_documents(read, spark):
    number = F.when(F.col("s_suppkey") % 4 == 0, "  ").otherwise(F.concat(F.lit(" "), "s_name"))
    issuer = F.when(F.col("s_suppkey") % 3 == 0, element("IssuingAuthority", {}, F.concat(F.lit("issuer "), "s_nationkey"))).otherwise("")
    fragment = element("IDRegDocument", {"ID": text("s_suppkey"), "IdentityID": F.concat(F.lit("i"), "s_nationkey"), "IDRegDocTypeID": F.lit("15")}, element("IDRegistrationNo", {}, number), issuer)
    return read("supplier").select(xml.parse(fragment, xml.DOCUMENT).alias("x")).select(*xml.document_columns(F.col("x")))


@query("select cast(l_orderkey as varchar) || '-' || l_linenumber as id, 's' || l_suppkey as from_profile_id, 'p' || l_partkey as to_profile_id, l_returnflag as relation_type_id from lineitem")
def xml_relationships(read, spark):
    fragment = element("ProfileRelationship", {"ID": F.concat(text("l_orderkey"), F.lit("-"), text("l_linenumber")), "From-ProfileID": F.concat(F.lit("s"), "l_suppkey"), "To-ProfileID": F.concat(F.lit("p"), "l_partkey"), "RelationTypeID": F.col("l_returnflag")}, "x")
    return dealt(read("lineitem"), "l_orderkey").select(xml.parse(fragment, xml.RELATIONSHIP).alias("x")).select(*xml.relationship_columns(F.col("x")))


@query("""select cast(o_orderkey as varchar) as feature_id, o_orderstatus as detail_value, year(o_orderdate) as start_year, case when o_orderkey % 2 = 0 then month(o_orderdate) end as start_month,
  case when o_orderkey % 3 = 0 then year(o_orderdate) + 1 end as end_year, 'L' || (o_custkey % 25) as location_id, case when o_orderkey % 4 = 0 then 'R' || o_custkey end as detail_reference_id from orders""")
def xml_features(read, spark):
    ymd = lambda tag, y, m: element(tag, {}, element("Year", {}, y), element("Month", {}, m), "<Day>x</Day>")
    year, even = F.year("o_orderdate"), F.col("o_orderkey") % 2 == 0
    start = ymd("From", year.cast("string"), F.when(even, F.month("o_orderdate").cast("string")).otherwise(""))
    end = F.when(F.col("o_orderkey") % 3 == 0, ymd("To", (year + 1).cast("string"), F.lit("1"))).otherwise("")
    details = F.when(F.col("o_orderkey") % 4 == 0, element("VersionDetail", {"DetailReferenceID": F.concat(F.lit("R"), "o_custkey")}, " ")).otherwise("")
    version = element("FeatureVersion", {}, element("DatePeriod", {}, element("Start", {}, start), element("End", {}, end)), element("VersionLocation", {"LocationID": F.concat(F.lit("L"), F.col("o_custkey") % 25)}), details, element("VersionDetail", {}, F.concat(F.lit(" "), "o_orderstatus")))
    fragment = element("DistinctParty", {"FixedRef": F.lit("1")}, element("Profile", {"ID": F.lit("1")}, element("Feature", {"ID": text("o_orderkey"), "FeatureTypeID": F.lit("8")}, version)))
    rows = dealt(read("orders"), "o_orderkey").select(xml.parse(fragment, xml.PARTY).alias("x")).select(*xml.party_columns(F.col("x")))
    f = spread(rows, "features").withColumnRenamed("features", "f")
    return f.select("f.feature_id", "f.detail_value", F.col("f.start.year").alias("start_year"), F.col("f.start.month").alias("start_month"), F.col("f.end.year").alias("end_year"), "f.location_id", "f.detail_reference_id")


@query("select n_name as label, cast(n_nationkey % 10 as varchar) as id from nation qualify row_number() over (partition by n_nationkey % 10 order by n_nationkey desc) = 1")
def label_last_wins(read, spark):
    rows = read("nation").select(F.lit("s").alias("snapshot_id"), F.col("n_nationkey").alias("pos"), F.lit("Country").alias("kind"), (F.col("n_nationkey") % 10).cast("string").alias("id"), F.trim(F.concat(F.lit(" "), "n_name")).alias("label"))
    return xml.last_labels(rows).select("id", "label")


@query("select doc_id, length(text) as n from documents where doc_id % 3 = 0")
def record_count_text(read, spark):
    line = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("<Record_Count>"), F.length("text"), F.lit("</Record_Count>"))).otherwise("<Other>1</Other>")
    return read("documents").select("doc_id", xml.record_count_in(line).alias("n")).where("n is not null")


@query("select source, count(*) as record_count from documents where doc_id % 4 <> 0 group by 1")
def csv_record_count(read, spark):
    line = F.concat(F.when(F.col("doc_id") % 4 == 0, " remarks, go on").otherwise(F.concat("doc_id", F.lit(',"x",-0- '))))
    return read("documents").where(files.starts_record(line)).groupBy("source").agg(F.count(F.lit(1)).alias("record_count"))


@query("select cast(c_custkey as varchar) as fixed_ref, 'p' || c_custkey as profile_id, 'i' || c_custkey as identity_id, cast(c_nationkey % 6 as varchar) as party_sub_type_id, 2 as n_aliases from customer")
def xml_files(read, spark):
    """As xml_roundtrip, but through text files and the reader that splits them."""
    folder = f"{shared_folder(spark)}/xml-{uuid.uuid4().hex}"
    party_fragments(read).select("fragment").write.text(folder)
    return xml.read_parties(spark, folder).select("fixed_ref", "profile_id", "identity_id", "party_sub_type_id", F.size("aliases").alias("n_aliases"))


@query("""select cast(n_nationkey as varchar) as location_id, n_name as country, 'l' || r_regionkey as list_id, r_name as list from nation join region on n_regionkey = r_regionkey""")
def xml_sections(read, spark):
    """Labels, locations and entries through text files, one scan and the stored sections."""
    folder = f"{shared_folder(spark)}/xml-{uuid.uuid4().hex}"
    n = read("nation").join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    key = text("n_nationkey")
    line = F.concat(element("Country", {"ID": key}, F.col("n_name")), element("List", {"ID": F.concat(F.lit("l"), "r_regionkey")}, F.lit(" "), F.col("r_name")), element("Location", {"ID": key}, element("LocationCountry", {"CountryID": key})), element("SanctionsEntry", {"ID": key, "ProfileID": key, "ListID": F.concat(F.lit("l"), "r_regionkey")}))
    n.select(line).write.text(folder)
    parts = xml.read_sections(spark, folder)
    named = resolve.with_label(parts["locations"], parts["labels"], "Country", "country_id", "country").select("location_id", "country")
    listed = resolve.with_label(parts["entries"], parts["labels"], "List", "list_id", "list").select(F.col("id").alias("location_id"), "list_id", "list")
    return named.join(listed, "location_id").select("location_id", "country", "list_id", "list")


# --- references ---------------------------------------------------------------------------------


def nation_labels(read, kind: str) -> DataFrame:
    return read("nation").select(F.lit("s").alias("snapshot_id"), F.lit(kind).alias("kind"), text("n_nationkey").alias("id"), F.col("n_name").alias("label"))


@query("select s_suppkey, coalesce(n_name, 'Unknown') as type from supplier left join nation on n_nationkey = s_nationkey + case when s_suppkey % 5 = 0 then 100 else 0 end")
def label_lookup(read, spark):
    rows = read("supplier").select(F.lit("s").alias("snapshot_id"), "s_suppkey", (F.col("s_nationkey") + F.when(F.col("s_suppkey") % 5 == 0, 100).otherwise(0)).cast("string").alias("id"))
    out = resolve.with_label(rows, nation_labels(read, "IDRegDocType"), "IDRegDocType", "id", "label")
    return out.select("s_suppkey", F.coalesce("label", F.lit(scalar.UNKNOWN)).alias("type"))


@query("""select cast(c_custkey as varchar) as fixed_ref, row_number() over (partition by c_custkey order by o_orderkey) - 1 as at, coalesce(n_name, 'Unknown') as type, o_orderpriority as number
from customer join orders on c_custkey = o_custkey left join nation on n_nationkey = o_orderkey % 30""")
def documents_resolved(read, spark):
    people = read("customer").select(F.lit("s").alias("snapshot_id"), F.col("c_custkey").alias("pos"), text("c_custkey").alias("fixed_ref"), text("c_custkey").alias("identity_id"))
    docs = read("orders").select(F.lit("s").alias("snapshot_id"), F.col("o_orderkey").alias("pos"), text("o_custkey").alias("identity_id"), (F.col("o_orderkey") % 30).cast("string").alias("type_id"), F.col("o_orderpriority").alias("number"), F.lit(None).cast("string").alias("issuer"))
    out, _ = resolve.resolve_documents(people, docs, nation_labels(read, "IDRegDocType"))
    return out.select(F.col("pos").cast("string").alias("fixed_ref"), F.posexplode("documents").alias("at", "d")).select("fixed_ref", F.col("at").cast("long").alias("at"), F.col("d.type").alias("type"), F.col("d.number").alias("number"))


FEATURES_SQL = """
f as (select user_id, event_id as at, case event_type when 'view' then 'Title' when 'click' then 'Gender' when 'error' then 'Place of Birth' when 'purchase' then 'Website' end as label, event_type,
  case when event_id % 7 = 0 then case when event_id % 2 = 0 then 'detail' end else event_type || cast(event_id as varchar) end as v from events),
g as (select *, row_number() over (partition by user_id, label order by "at") as rn from f where v is not null)
"""


def event_features(read, spark) -> tuple[DataFrame, DataFrame]:
    e = read("events")
    inline = F.when(F.col("event_id") % 7 == 0, " ").otherwise(F.concat("event_type", text("event_id")))
    reference = F.when(F.col("event_id") % 7 == 0, F.when(F.col("event_id") % 2 == 0, "1").otherwise("9"))
    none = F.lit(None).cast(schemas.DATE)
    rows = e.select(F.lit("s").alias("snapshot_id"), F.col("user_id").alias("pos"), text("user_id").alias("fixed_ref"), F.col("event_id").alias("at"), F.col("event_type").alias("feature_type_id"), inline.alias("detail_value"), none.alias("start"), none.alias("end"), F.lit(None).cast("string").alias("location_id"), reference.alias("detail_reference_id"))
    labels = [("s", "FeatureType", "view", "Title"), ("s", "FeatureType", "click", "Gender"), ("s", "FeatureType", "error", "Place of Birth"), ("s", "FeatureType", "purchase", "Website"), ("s", "DetailReference", "1", "detail")]
    locations = spark.createDataFrame([], schemas.LOCATION)
    return resolve.routed_features(rows, spark.createDataFrame(labels, "snapshot_id string, kind string, id string, label string"), locations)


@query(f"""with {FEATURES_SQL} select user_id, max(case when label = 'Title' and rn = 1 then v end) as title, max(case when label = 'Place of Birth' and rn = 1 then v end) as place_of_birth,
  max(case when label = 'Gender' and rn = 1 then v end) as gender from (select distinct user_id from events) left join g using (user_id) group by 1""")
def feature_promotion(read, spark):
    return resolve.nested_features(event_features(read, spark)[0]).select(F.col("pos").alias("user_id"), "title", "place_of_birth", "gender")


@query(f"""with {FEATURES_SQL}, rest as (select * from g where coalesce(label, event_type) not in ('Title', 'Gender', 'Place of Birth') or rn > 1)
select user_id, row_number() over (partition by user_id order by "at") - 1 as at, coalesce(label, event_type) as type, v as value from rest""")
def feature_routing(read, spark):
    out = resolve.nested_features(event_features(read, spark)[0]).select(F.col("pos").alias("user_id"), F.posexplode("features").alias("at", "f"))
    return out.select("user_id", F.col("at").cast("long").alias("at"), F.col("f.type").alias("type"), F.col("f.value").alias("value"))


@query("""select cast(user_id as varchar) as fixed_ref, case when event_type in ('view', 'click', 'error') then 'DROPPED_VALUE' else 'UNRESOLVED_REF' end as kind, count(*) as n from events
where event_id % 7 = 0 and event_id % 2 = 1 group by 1, 2""")
def feature_diagnostics(read, spark):
    return event_features(read, spark)[1].groupBy("fixed_ref", "kind").agg(F.count(F.lit(1)).alias("n"))


def places(read) -> tuple[DataFrame, DataFrame]:
    """Nations as locations: country is the region's name, but for every fourth; parts are the nation's name twice typed and once not."""
    rows = read("nation").join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    part = lambda t, v: F.struct(F.lit(t).cast("string").alias("loc_part_type_id"), v.alias("value"))
    parts = F.when(F.col("n_nationkey") % 3 == 0, F.array().cast("array<struct<loc_part_type_id:string,value:string>>")).otherwise(F.array(part("1", F.col("n_name")), part("1", F.col("r_name")), part(None, F.lit("x"))))
    locations = rows.select(F.lit("s").alias("snapshot_id"), text("n_nationkey").alias("location_id"), F.when(F.col("n_nationkey") % 4 != 0, text("n_regionkey")).alias("country_id"), parts.alias("parts"))
    labels = read("region").select(F.lit("s").alias("snapshot_id"), F.lit("Country").alias("kind"), text("r_regionkey").alias("id"), F.col("r_name").alias("label"))
    return locations, labels


PLACES_SQL = """
p as (select n_nationkey, case when n_nationkey % 4 <> 0 then r_name end as country, case when n_nationkey % 3 = 0 then '' else n_name || ', ' || r_name || ', x' end as joined,
  case when n_nationkey % 3 <> 0 then r_name end as city from nation join region on n_regionkey = r_regionkey),
c as (select c_custkey, case when c_custkey % 10 = 0 then null else c_nationkey + case when c_custkey % 9 = 0 then 100 else 0 end end as loc, case when c_custkey % 6 = 0 then c_name end as inline from customer)
"""


def placed_customers(read) -> DataFrame:
    locations, labels = places(read)
    key = F.col("c_custkey")
    location = F.when(key % 10 == 0, None).otherwise((F.col("c_nationkey") + F.when(key % 9 == 0, 100).otherwise(0)).cast("string"))
    rows = read("customer").select(F.lit("s").alias("snapshot_id"), "c_custkey", location.alias("location_id"), F.when(key % 6 == 0, F.col("c_name")).alias("inline"))
    return rows.join(resolve.resolve_locations(locations, labels), ["snapshot_id", "location_id"], "left")


@query(f"with {PLACES_SQL} select c_custkey, coalesce(inline, country, nullif(joined, '')) as country from c left join p on loc = n_nationkey")
def country_value(read, spark):
    return placed_customers(read).select("c_custkey", resolve.country_value(F.col("inline"), F.col("country"), F.col("joined")).alias("country"))


@query(f"""with {PLACES_SQL}, a as (select c_custkey, country, city, case when loc is null then inline else coalesce(nullif(joined, ''), country) end as raw from c left join p on loc = n_nationkey)
select c_custkey, raw, case when raw is not null then country end as country, case when raw is not null then city end as city from a""")
def address_build(read, spark):
    a = resolve.address_value(F.col("inline"), F.col("location_id"), F.col("country"), F.col("joined"), F.col("parts"))
    return placed_customers(read).withColumn("a", a).select("c_custkey", "a.raw", "a.country", F.try_element_at("a.parts", F.lit("1")).alias("city"))


ORDER_DATES_SQL = """d as (select o_orderkey, year(o_orderdate) as y, month(o_orderdate) as m, day(o_orderdate) as dd from orders),
e as (select o_orderkey, case when o_orderkey % 5 <> 0 then y end as sy, case when o_orderkey % 3 <> 0 then m end as sm, dd as sd,
  case o_orderkey % 4 when 0 then null when 1 then y when 2 then y + 1 else y end as ey, case when o_orderkey % 3 <> 0 then m end as em, case when o_orderkey % 4 = 3 then dd + 1 else dd end as ed from d)"""


@query(f"""with {ORDER_DATES_SQL}, s as (select *, sy is not null as a, ey is not null as b, sy is not null and ey is not null and (sy <> ey or sd <> ed) as two from e)
select o_orderkey, case when not two then coalesce(sy, ey) end as year, case when two or not (a or b) then null when a then sm else em end as month, case when two or not (a or b) then null when a then sd else ed end as day,
  case when two then sy end as from_year, case when two then ey end as to_year from s""")
def partial_dates(read, spark):
    k, y, m, d = F.col("o_orderkey"), F.year("o_orderdate"), F.month("o_orderdate"), F.day("o_orderdate")
    month = F.when(k % 3 != 0, m)
    start = scalar.date_parts(F.when(k % 5 != 0, y), month, d)
    end = scalar.date_parts(F.when(k % 4 == 0, None).when(k % 4 == 2, y + 1).otherwise(y), month, F.when(k % 4 == 3, d + 1).otherwise(d))
    out = read("orders").select("o_orderkey", scalar.partial_date(start, end).alias("p"))
    return out.select("o_orderkey", "p.year", "p.month", "p.day", F.col("p.period.from.year").alias("from_year"), F.col("p.period.to.year").alias("to_year"))


@query("""select o_orderkey, case when o_orderkey % 7 = 0 then case when o_orderkey % 2 = 0 then cast(o_orderdate as date) else date '2020-02-02' end
  else make_date(year(o_orderdate), case when o_orderkey % 5 = 0 then 1 when o_orderkey % 3 = 0 then 12 else month(o_orderdate) end, least(day(o_orderdate), 28)) end::varchar as publish_date from orders""")
def publish_dates(read, spark):
    k = F.col("o_orderkey")
    year = F.when(k % 7 != 0, F.year("o_orderdate"))
    month = F.when(k % 5 == 0, None).when(k % 3 == 0, F.month("o_orderdate") + 12).otherwise(F.month("o_orderdate"))
    modified = F.when(k % 2 == 0, F.concat(F.date_format("o_orderdate", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))).otherwise("not a date")
    return read("orders").select("o_orderkey", scalar.publish_date(year, month, F.day("o_orderdate"), modified, F.lit("2020-02-02")).cast("string").alias("publish_date"))


@query("select o_orderkey, case o_orderkey % 4 when 0 then null when 1 then null when 2 then o_custkey when 3 then 0 end as n from orders")
def record_counts(read, spark):
    k = F.col("o_orderkey") % 4
    given = F.when(k == 0, F.concat(F.lit("-"), F.col("o_custkey") + 1)).when(k == 1, "12x").when(k == 2, F.concat(F.lit(" "), "o_custkey", F.lit(" "))).otherwise("0")
    return read("orders").select("o_orderkey", scalar.record_count(given).cast("long").alias("n"))


@query("select doc_id, case doc_id % 5 when 4 then null else sha256(coalesce(text, '')) end as digest from documents")
def digest_normalise(read, spark):
    sha, k = F.sha2(F.coalesce("text", F.lit("")), 256), F.col("doc_id") % 5
    given = F.when(k == 0, sha).when(k == 1, F.concat(F.lit("sha-256="), F.base64(F.unhex(sha)))).when(k == 2, F.concat(F.lit("SHA256: "), F.upper(sha))).when(k == 3, F.concat(F.lit("sha-256"), sha)).otherwise(F.concat(F.lit("md5="), sha))
    return read("documents").select("doc_id", scalar.normalise_digest(given).alias("digest"))


@query("""select o_orderkey, case when o_orderkey % 3 = 0 then null else make_date(year(o_orderdate), month(o_orderdate), case when o_orderkey % 5 = 0 then 1 else day(o_orderdate) end)::varchar end as day from orders""")
def strict_dates(read, spark):
    k = F.col("o_orderkey")
    day = F.when(k % 3 == 0, 31).when(k % 5 == 0, None).otherwise(F.day("o_orderdate"))
    month = F.when(k % 3 == 0, 2).otherwise(F.month("o_orderdate"))
    return read("orders").select("o_orderkey", scalar.clamped_date(F.year("o_orderdate"), month, day, strict=True).cast("string").alias("day"))


PROGRAMS_SQL = """
e as (select o_custkey, o_orderkey, case when o_custkey % 4 = 0 then null else o_orderpriority end as program, case when o_custkey % 8 = 0 then null when o_orderkey % 2 = 0 then o_orderstatus end as list from orders),
d as (select o_custkey, program, min(o_orderkey) as first from e where program is not null group by 1, 2),
fallback as (select o_custkey, min_by(list, o_orderkey) as program from e where list is not null group by 1 having o_custkey not in (select o_custkey from d)),
programs as (select o_custkey, row_number() over (partition by o_custkey order by first) - 1 as place, program from d union all select o_custkey, 0, program from fallback)
"""


def customer_programs(read) -> DataFrame:
    k = F.col("o_custkey")
    programs = F.when(k % 4 == 0, F.array().cast("array<string>")).otherwise(F.array("o_orderpriority"))
    entries = read("orders").select(F.lit("s").alias("snapshot_id"), F.col("o_orderkey").alias("pos"), text("o_custkey").alias("profile_id"), F.when(k % 8 == 0, None).when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("list_id"), programs.alias("programs"))
    labels = read("orders").select("o_orderstatus").distinct().select(F.lit("s").alias("snapshot_id"), F.lit("List").alias("kind"), F.col("o_orderstatus").alias("id"), F.col("o_orderstatus").alias("label"))
    people = read("customer").select(F.lit("s").alias("snapshot_id"), F.col("c_custkey").alias("pos"), text("c_custkey").alias("profile_id"))
    return resolve.resolve_programs(people, entries, labels)


@query(f"with {PROGRAMS_SQL} select o_custkey as c_custkey, place, program from programs")
def programs_distinct(read, spark):
    return customer_programs(read).select(F.col("pos").alias("c_custkey"), F.posexplode("sanction_programs").alias("place", "program")).select("c_custkey", F.col("place").cast("long").alias("place"), "program")


REJECTS_SQL = f"""{PROGRAMS_SQL}, r as (select c_mktsegment as snapshot_id, c_custkey as pos, case when c_custkey % 50 = 0 then ' ' else cast(c_custkey as varchar) end as fixed_ref,
  case when c_custkey % 50 = 0 then 'BLANK_FIXED_REF' when c_custkey % 31 = 0 then 'NO_NAME' when c_custkey not in (select o_custkey from programs) then 'NO_PROGRAM' end as reject_reason from customer)"""


def rejects(read) -> DataFrame:
    k = F.col("c_custkey")
    rows = read("customer").select(F.col("c_mktsegment").alias("snapshot_id"), k.alias("pos"), F.when(k % 50 == 0, " ").otherwise(text("c_custkey")).alias("fixed_ref"), F.when(k % 31 == 0, 0).otherwise(1).alias("names"))
    rows = rows.join(customer_programs(read).select("pos", F.size("sanction_programs").alias("programs")), "pos", "left")
    return rows.withColumn("reject_reason", resolve.reject_reason(F.col("fixed_ref"), F.col("names"), F.col("programs")))


@query(f"with {REJECTS_SQL} select snapshot_id, case when count(reject_reason) > 0 then 'FAILED' else 'BUILT' end as status, min_by(fixed_ref, pos) filter (reject_reason is not null) as fixed_ref, min_by(reject_reason, pos) filter (reject_reason is not null) as reject_reason from r group by 1")
def unbuildable_gate(read, spark):
    return resolve.first_failure(rejects(read))


@query(f"with {REJECTS_SQL} select snapshot_id, case reject_reason when 'BLANK_FIXED_REF' then 'fixed_ref' when 'NO_NAME' then 'primary_name' else 'sanction_programs' end as field, fixed_ref, reject_reason as detail from r where reject_reason is not null")
def mapping_errors(read, spark):
    return resolve.mapping_errors(rejects(read))


def related(read) -> tuple[DataFrame, DataFrame]:
    s = F.lit("s").alias("snapshot_id")
    people = read("supplier").select(s, F.col("s_suppkey").alias("pos"), F.col("s_name").alias("fixed_ref"), F.concat(F.lit("s"), "s_suppkey").alias("profile_id"))
    everyone = people.unionByName(read("part").where("p_partkey % 10 <> 0").select(s, (F.col("p_partkey") + 1_000_000_000).alias("pos"), text("p_partkey").alias("fixed_ref"), F.concat(F.lit("p"), "p_partkey").alias("profile_id")))
    links = read("lineitem").select(s, (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("pos"), F.lit("").alias("id"), F.concat(F.lit("s"), "l_suppkey").alias("from_profile_id"), F.concat(F.lit("p"), "l_partkey").alias("to_profile_id"), F.col("l_returnflag").alias("relation_type_id"))
    flags = read("lineitem").select("l_returnflag").distinct().where("l_returnflag <> 'N'").select(s, F.lit("RelationType").alias("kind"), F.col("l_returnflag").alias("id"), F.concat(F.lit("rel "), "l_returnflag").alias("label"))
    flags = stored(flags)  # of known size, so it goes to the links; else these are shuffled by a key of few values
    return resolve.resolve_relationships(people, everyone, links, flags)


@query("""select l_suppkey as s_suppkey, cast(l_partkey as varchar) as to_fixed_ref, case when l_returnflag = 'N' then 'Unknown' else 'rel ' || l_returnflag end as relation_type, count(*) as n
from lineitem join supplier on l_suppkey = s_suppkey join part on l_partkey = p_partkey where p_partkey % 10 <> 0 group by all""")
def relationships_resolved(read, spark):
    out = related(read)[0].select(F.col("pos").alias("s_suppkey"), F.explode("relationships").alias("r"))
    return out.groupBy("s_suppkey", "r.to_fixed_ref", "r.relation_type").agg(F.count(F.lit(1)).alias("n"))


@query("""select s_name as fixed_ref, case when p_partkey is null or p_partkey % 10 = 0 then 'target profile p' || l_partkey else 'relation type N' end as detail, count(*) as n
from lineitem join supplier on l_suppkey = s_suppkey left join part on l_partkey = p_partkey where p_partkey is null or p_partkey % 10 = 0 or l_returnflag = 'N' group by all""")
def relationship_diagnostics(read, spark):
    return related(read)[1].groupBy("fixed_ref", "detail").agg(F.count(F.lit(1)).alias("n"))


# --- dedup and counts ---------------------------------------------------------------------------


@query("select cast(o_custkey as varchar) as fixed_ref, min(o_orderkey) as pos, min_by(o_orderstatus, o_orderkey) as status from orders group by 1")
def dedup_within(read, spark):
    rows = read("orders").select(text("o_custkey").alias("fixed_ref"), F.col("o_orderkey").alias("pos"), F.col("o_orderstatus").alias("status"))
    return dedup.dedup_within(rows)


LISTS_SQL = """lists as (select 'SDN' as source_list, cast(c_custkey * 2 as varchar) as fixed_ref, c_custkey as pos, c_name as name from customer
union all select 'CONSOLIDATED', cast(s_suppkey * 3 as varchar), s_suppkey, s_name from supplier union all select 'CONSOLIDATED', cast(s_suppkey * 3 as varchar), s_suppkey + 1000000, s_name || ' again' from supplier)"""


def two_lists(read) -> DataFrame:
    of = lambda table, name, key, step, more, label: read(table).select(F.lit(name).alias("source_list"), (F.col(key) * step).cast("string").alias("fixed_ref"), (F.col(key) + more).alias("pos"), label.alias("name"))
    one = of("customer", "SDN", "c_custkey", 2, 0, F.col("c_name"))
    two = of("supplier", "CONSOLIDATED", "s_suppkey", 3, 0, F.col("s_name"))
    again = of("supplier", "CONSOLIDATED", "s_suppkey", 3, 1_000_000, F.concat("s_name", F.lit(" again")))
    return one.unionByName(two).unionByName(again)


@query(f"with {LISTS_SQL} select source_list, fixed_ref, name from lists qualify row_number() over (partition by fixed_ref order by source_list desc, pos) = 1")
def dedup_union(read, spark):
    return dedup.dedup_across(two_lists(read), scope.lists_in_scope("SDN_AND_CONSOLIDATED")).select("source_list", "fixed_ref", "name")


@query(f"with {LISTS_SQL} select fixed_ref, name from lists where source_list = 'SDN'")
def dedup_one_list(read, spark):
    return dedup.dedup_across(two_lists(read), scope.lists_in_scope(" SDN_ONLY ")).select("fixed_ref", "name")


@query(f"""with {LISTS_SQL}, a as (select distinct fixed_ref from lists where source_list = 'SDN'), b as (select distinct fixed_ref from lists where source_list = 'CONSOLIDATED')
select (select count(*) from a where fixed_ref in (select fixed_ref from b)) as shared, (select count(*) from a where fixed_ref not in (select fixed_ref from b)) as only_left, (select count(*) from b where fixed_ref not in (select fixed_ref from a)) as only_right""")
def list_overlap(read, spark):
    rows = two_lists(read)
    return dedup.list_overlap(rows.where("source_list = 'SDN'"), rows.where("source_list = 'CONSOLIDATED'"))


@query(f"with {LISTS_SQL} select fixed_ref from (select distinct fixed_ref from lists where source_list = 'SDN') where fixed_ref not in (select fixed_ref from lists where source_list = 'CONSOLIDATED')")
def ids_gone(read, spark):
    rows = two_lists(read)
    return compare.ids_gone(rows.where("source_list = 'SDN'").select("fixed_ref").distinct(), rows.where("source_list = 'CONSOLIDATED'").select("fixed_ref").distinct())


@query(f"with {LISTS_SQL} select distinct fixed_ref from lists where source_list = 'SDN' and fixed_ref in (select fixed_ref from lists where source_list = 'CONSOLIDATED')")
def ids_shared(read, spark):
    rows = two_lists(read)
    return compare.ids_shared(rows.where("source_list = 'SDN'"), rows.where("source_list = 'CONSOLIDATED'"))


@query(f"""with {LISTS_SQL}, n as (select source_list, count(*) as record_count, count(distinct fixed_ref) as persisted_count from lists group by 1)
select source_list, record_count, persisted_count, record_count as expected_count, case when record_count = persisted_count then 'OK' else 'COUNT_MISMATCH' end as gate from n""")
def count_gate(read, spark):
    n = two_lists(read).groupBy("source_list").agg(F.count(F.lit(1)).alias("record_count"), F.count_distinct("fixed_ref").alias("persisted_count"))
    n = n.withColumns({"out_of_scope_count": F.lit(0), "overlap_count": F.lit(None).cast("long")})
    return counts.count_gate(counts.expected_count(n)).select("source_list", "record_count", "persisted_count", "expected_count", "gate")


@query(f"""with {LISTS_SQL}, k as (select *, cast(fixed_ref as bigint) % 6 in (0, 2, 3) as inside from lists),
per as (select source_list, count(distinct fixed_ref) as n from k where inside group by 1)
select (select count(*) from k) as record_count, (select count(*) from k where not inside) as out_of_scope_count, (select sum(n) from per)::bigint - (select count(distinct fixed_ref) from k where inside) as overlap_count""")
def count_reconcile(read, spark):
    k = two_lists(read).withColumn("inside", (F.col("fixed_ref").cast("long") % 6).isin(0, 2, 3))
    per = k.where("inside").groupBy("source_list").agg(F.count_distinct("fixed_ref").alias("in_scope_count"))
    union = k.where("inside").agg(F.count_distinct("fixed_ref").alias("n"))
    total = k.agg(F.count(F.lit(1)).alias("record_count"), F.count_if(~F.col("inside")).alias("out_of_scope_count"))
    return total.join(counts.overlap(per, union))


@query(f"""with {PARTIES_SQL}, n as (select case when pos % 2 = 0 then 'SDN' else 'CONSOLIDATED' end as source_list, count(*) filter (party_class not in ('Individual', 'Entity')) as o from classified group by 1)
select sum(o)::bigint as out_of_scope_count, cast(null as bigint) as record_count, 'FAILED' as status, 'CONSOLIDATED' as failed_list from n""")
def combine_lists(read, spark):
    rows = parties(read).withColumn("source_list", F.when(F.col("pos") % 2 == 0, "SDN").otherwise("CONSOLIDATED"))
    n = scope.scope_counts(rows, by=("source_list",)).withColumn("status", F.when(F.col("source_list") == "SDN", "BUILT").otherwise("FAILED"))
    return dedup.combine_counts(n)


# --- landing, validation, cycle -----------------------------------------------------------------

SNAPSHOTS_SQL = """
s as (select doc_id, 'L' || doc_id as source_list, sha256(coalesce(text, '')) as actual, length(coalesce(text, '')) as n, doc_id % 11 as k from documents),
m as (select *, case k when 1 then null when 2 then sha256('other') else actual end as claimed, case k when 3 then 500 when 4 then 204 else 200 end as status, case k when 5 then 6 when 6 then 5 end as redirects,
  case k when 7 then n + 1 when 8 then null else n end as declared from s)
"""


def snapshots(read) -> DataFrame:
    t, k = F.coalesce("text", F.lit("")), F.col("doc_id") % 11
    actual = F.sha2(t, 256)
    claimed = F.when(k == 1, None).when(k == 2, F.sha2(F.lit("other"), 256)).otherwise(F.concat(F.lit("sha-256="), actual))
    return read("documents").select(
        "doc_id", k.alias("k"), F.concat(F.lit("L"), "doc_id").alias("source_list"), text("doc_id").alias("path"), actual.alias("actual_digest"), claimed.alias("digest_header"), (k != 9).alias("well_formed"),
        F.when(k == 3, 500).when(k == 4, 204).otherwise(200).alias("status"), F.when(k == 5, 6).when(k == 6, 5).alias("redirects"),
        F.when(k == 7, F.length(t) + 1).when(k == 8, None).otherwise(F.length(t)).cast("long").alias("content_length"), F.length(t).cast("long").alias("length"),
    )


@query(f"with {SNAPSHOTS_SQL} select doc_id, status between 200 and 299 and coalesce(redirects, 0) <= 5 and (declared is null or declared = n) as complete from m")
def download_complete(read, spark):
    rows = snapshots(read)
    return counts.downloads(rows.drop("length"), rows.select("path", "length")).select("doc_id", "complete")


@query(f"with {SNAPSHOTS_SQL} select doc_id, case when claimed is null then 'ABSENT_DIGEST' when claimed <> actual then 'DIGEST_MISMATCH' when k = 9 then 'MALFORMED_XML' else 'OK' end as verdict from m")
def validate_snapshots(read, spark):
    return counts.validated(snapshots(read)).select("doc_id", "verdict")


CHANGES_SQL = f"""{SNAPSHOTS_SQL}, c as (select doc_id, case when doc_id % 5 = 0 then false
  when doc_id % 4 in (0, 1) then doc_id % 3 = 0 else doc_id % 4 = 2 and doc_id % 3 = 1 end as same from s)"""


def advertised(read) -> tuple[DataFrame, DataFrame]:
    """A manifest of documents, and their last versions: none for every fifth; half of the manifest has digests, some of them changed."""
    rows, k = snapshots(read), F.col("doc_id")
    manifest = rows.withColumns({
        "digest": F.when((k % 4).isin(0, 1), F.col("actual_digest")),
        "advertised_date": F.when(k % 4 == 2, F.lit("2026-01-01").cast("date")),
        "advertised_count": F.when(k % 4 == 2, F.col("length")),
    })
    last = rows.where(k % 5 != 0).select("source_list", F.when(k % 3 == 0, F.col("actual_digest")).otherwise(F.sha2(F.lit("old"), 256)).alias("digest"), F.lit("2026-01-01").cast("date").alias("publish_date"), F.when(k % 3 == 1, F.col("length")).otherwise(F.col("length") + 1).alias("record_count"))
    return manifest, last


@query(f"with {CHANGES_SQL} select doc_id, case when same then 'UNCHANGED' else 'CHANGED' end as decision from c")
def change_detect(read, spark):
    return counts.changed(*advertised(read)).select("doc_id", "decision")


OUTCOMES_SQL = f"""{CHANGES_SQL}, o as (select doc_id, case when same then null when not (status between 200 and 299 and coalesce(redirects, 0) <= 5 and (declared is null or declared = n)) then 'OBTAIN|INCOMPLETE_DOWNLOAD'
  when claimed is null then 'VALIDATE|ABSENT_DIGEST' when claimed <> actual then 'VALIDATE|DIGEST_MISMATCH' when k = 9 then 'VALIDATE|MALFORMED_XML'
  when doc_id % 13 = 0 then 'TRANSFORM|NO_PROGRAM' when doc_id % 17 = 0 then 'PUBLISH|COUNT_MISMATCH' end as stage, same from m join c using (doc_id))"""


@query(f"with {OUTCOMES_SQL} select doc_id, case when same then 'SKIPPED' when stage is null then 'ACTIVATED' else 'FAILED' end as status, split_part(stage, '|', 1) as failed_stage, split_part(stage, '|', 2) as cause from o")
def cycle_outcomes(read, spark):
    manifest, last = advertised(read)
    rows = counts.downloads(manifest.drop("length"), manifest.select("path", "length"))
    rows = rows.withColumns({"reject_reason": F.when(F.col("doc_id") % 13 == 0, "NO_PROGRAM"), "expected_count": F.lit(1), "persisted_count": F.when(F.col("doc_id") % 17 == 0, 0).otherwise(1)})
    return cycle.outcomes(rows.drop("status"), last).select("doc_id", "status", "failed_stage", "cause")


@query("select doc_id, case when doc_id % 9 = 0 then false when doc_id % 7 = 0 then false else true end as ok from documents")
def digest_verify(read, spark):
    key = [F.lit("SDN").alias("source_list"), F.lit("2026-01-01").cast("date").alias("publish_date")]
    docs = read("documents").withColumn("text", F.coalesce("text", F.lit("")))
    recorded = docs.select("doc_id", *key, F.concat(F.sha2("text", 256), F.lit(":"), "doc_id").alias("digest"))
    stored = docs.where("doc_id % 9 <> 0").select("doc_id", F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text")).alias("content"))
    now = stored.select("doc_id", F.sha2("content", 256).alias("digest"), "content")
    versions_ = recorded.select("doc_id", F.concat(F.lit("L"), "doc_id").alias("source_list"), "publish_date", F.substring_index("digest", ":", 1).alias("digest"))
    files = now.join(versions_.select("doc_id", "source_list", "publish_date", F.col("digest").alias("wanted")), "doc_id").select("source_list", "publish_date", F.col("wanted").alias("digest"), "content")
    return counts.integrity(versions_, files).select("doc_id", "ok")


@query("select user_id as v, max_by(event_id % 3 <> 0, ts) as ok from events group by 1")
def latest_integrity(read, spark):
    rows = read("events").select(F.lit("SDN").alias("source_list"), F.lit("2026-01-01").cast("date").alias("publish_date"), text("user_id").alias("digest"), (F.col("event_id") % 3 != 0).alias("ok"), F.col("ts").alias("checked_at"))
    return counts.latest_checks(rows).select(F.col("digest").cast("long").alias("v"), "ok")


@query("select doc_id from documents where doc_id % 3 <> 0")
def landing_new(read, spark):
    rows = read("documents").select("doc_id", F.lit("SDN").alias("source_list"), F.lit("2026-01-01").cast("date").alias("publish_date"), text("doc_id").alias("digest"))
    return files.new_files(rows, rows.where("doc_id % 3 = 0").drop("doc_id")).select("doc_id")


# --- versions -----------------------------------------------------------------------------------


def activations(read) -> DataFrame:
    return read("events").select(F.col("event_type").alias("source_list"), F.col("event_id").alias("seq"), F.col("user_id").alias("version"))


ONE = ["version"]
TRIO_SQL = """a as (select event_type as source_list, event_id as seq, user_id as version from events),
t as (select source_list, version, case row_number() over (partition by source_list order by seq desc) when 1 then 'CURRENT' when 2 then 'PREVIOUS' when 3 then 'N_MINUS_2' end as pointer from a qualify pointer is not null),
v as (select distinct event_type as source_list, user_id as version from events union all select distinct event_type, -1 from events)"""


def known_versions(read) -> DataFrame:
    rows = activations(read).select("source_list", "version").distinct()
    return rows.unionByName(rows.select("source_list", F.lit(-1).cast("long").alias("version")).distinct())


@query(f"with {TRIO_SQL} select source_list, pointer, version from t")
def pointer_trio(read, spark):
    return versions.trio(activations(read), ONE)


@query(f"with {TRIO_SQL} select source_list, version from t where pointer = 'PREVIOUS'")
def pointer_previous(read, spark):
    return versions.pointer(activations(read), "PREVIOUS", ONE)


@query(f"with {TRIO_SQL} select source_list, version, case when exists (select 1 from t where t.source_list = v.source_list and t.version = v.version) then 'HOT' else 'COLD' end as state from v")
def hot_cold(read, spark):
    return versions.hot_cold(known_versions(read), activations(read), ONE)


@query(f"with {TRIO_SQL} select source_list, version, 'COLD' as state from v where not exists (select 1 from t where t.source_list = v.source_list and t.version = v.version)")
def cold_versions(read, spark):
    return versions.cold_versions(known_versions(read), activations(read), ONE)


@query(f"with {TRIO_SQL} select source_list, version, 'COLD' as state from v where version % 2 < 1 and not exists (select 1 from t where t.source_list = v.source_list and t.version = v.version)")
def purge_plan(read, spark):
    aged = known_versions(read).withColumn("ingested_at", F.col("version") % 2)
    return versions.purge_plan(aged, activations(read), keep_all=False, version=ONE, older_than=F.lit(1)).drop("ingested_at")


@query(f"with {TRIO_SQL} select source_list, case pointer when 'CURRENT' then 'PREVIOUS' when 'PREVIOUS' then 'CURRENT' end as pointer, version from t where pointer <> 'N_MINUS_2' union all select source_list, 'N_MINUS_2', version from t where pointer = 'PREVIOUS'")
def rollback_trio(read, spark):
    return versions.trio(versions.rolled_back(activations(read), ONE), ONE)


@query("select event_type as source_list, max_by(user_id, event_id) as v, max(event_id) as at from events group by 1")
def last_ingested(read, spark):
    rows = read("events").select(F.col("event_type").alias("source_list"), F.col("event_id").alias("ingested_at"), F.lit("2026-01-01").cast("date").alias("publish_date"), F.lit("d").alias("digest"), F.col("user_id").alias("v"))
    return versions.last_ingested(rows).select("source_list", "v", F.col("ingested_at").alias("at"))


@query("select c_custkey, 'SDN' as source_list, '2026-08-20' as publish_date, 'abc' as digest from customer")
def version_stamp(read, spark):
    return versions.stamp(read("customer").select("c_custkey"), "SDN", "2026-08-20", "abc").withColumn("publish_date", text("publish_date"))


STORED = {"source_list": "SDN", "publish_date": datetime.date(2026, 1, 1)}


def records_of(read) -> DataFrame:
    """Customers as records with one alias each."""
    rows = read("customer").select(text("c_custkey").alias("fixed_ref"), F.lit("Entity").alias("entity_type"), F.col("c_name").alias("primary_name"), F.array(F.struct(F.col("c_mktsegment").alias("name"), F.lit(None).cast("string").alias("type"), F.lit(False).alias("is_primary"), F.lit("STRONG").alias("category"))).alias("aliases"))
    empty = {f.split(" ")[0]: f.split(" ", 1)[1] for f in schemas.top_level(schemas.RECORD_FIELDS)}
    return rows.withColumns({c: F.lit(None).cast(kind) for c, kind in empty.items() if c not in rows.columns})


@query("select cast(c_custkey as varchar) as fixed_ref, lower(c_name) as primary_name_lower, lower(c_mktsegment) as alias_search, 'b' as digest from customer where c_custkey % 2 = 0")
def store_current(read, spark):
    """Two versions written, the second one active, a third not activated: the records that readers see."""
    store = Store(spark, f"{shared_folder(spark)}/store-{uuid.uuid4().hex}")
    rows = records_of(read)
    for digest, kept in (("a", rows), ("b", rows.where("fixed_ref % 2 = 0")), ("c", rows.where("fixed_ref % 2 = 1"))):
        store.put_isolated(kept, **STORED, digest=digest, counts={"record_count": 0, "out_of_scope_count": 0, "expected_count": 0}, raw_path="-")
        if digest != "c":
            store.activate(**STORED, digest=digest)
    return store.current("SDN").select("fixed_ref", "primary_name_lower", "alias_search", "digest")


@query("""select digest, record_count, persisted_count from (select 'a' as digest, count(*) as record_count, count(*) as persisted_count from customer union all
select 'b', count(*), count(*) filter (c_custkey % 2 = 0) from customer)""")
def store_versions(read, spark):
    store = Store(spark, f"{shared_folder(spark)}/store-{uuid.uuid4().hex}")
    rows = records_of(read)
    n = rows.count()
    for digest, kept in (("a", rows), ("b", rows.where("fixed_ref % 2 = 0"))):
        store.put_isolated(kept, **STORED, digest=digest, counts={"record_count": n, "out_of_scope_count": 0, "expected_count": n}, raw_path="-")
    return store.versions().select("digest", "record_count", "persisted_count")


@query("""with d as (select doc_id % 50 as v, doc_id, text from documents where text is not null), f as (select v, min_by(text, doc_id) as text from d group by 1)
select cast(v as varchar) as digest, v % 7 <> 0 as ok from f where v >= 3""")
def cold_integrity(read, spark):
    """Stored texts hashed again: versions that are not among the last three activated, every seventh one tampered with."""
    docs = read("documents").where("text is not null").groupBy((F.col("doc_id") % 50).alias("v")).agg(F.min_by("text", "doc_id").alias("text")).withColumn("text", F.concat("v", F.lit(" "), "text"))
    key = [F.lit("SDN").alias("source_list"), F.lit("2026-01-01").cast("date").alias("publish_date"), F.sha2("text", 256).alias("digest")]
    known = stored(docs.select(*key, "v", "text"))
    bytes_ = known.select("source_list", "publish_date", "digest", F.when(F.col("v") % 7 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text")).alias("content"))
    active = known.where("v < 3").select("source_list", (-F.col("v")).alias("seq"), "publish_date", "digest")
    found = counts.cold_checks(known.drop("text"), active, bytes_)
    return found.select(text("v").alias("digest"), "ok")


@query("select doc_id, sha256(coalesce(text, '')) as digest, sha256(coalesce(text, '')) as stored from documents")
def raw_landing(read, spark):
    """Texts landed as raw bytes and read back; a second landing writes nothing."""
    folder = f"{shared_folder(spark)}/raw-{uuid.uuid4().hex}"
    content = F.coalesce("text", F.lit("")).cast("binary")
    rows = read("documents").select(F.lit("SDN").alias("source_list"), F.date_add(F.lit("2026-01-01").cast("date"), (F.col("doc_id") % 5).cast("int")).alias("publish_date"), F.concat("doc_id", F.lit("-"), F.sha2(content, 256)).alias("digest"), text("doc_id").alias("path"), content.alias("content"))
    # few partitions: one for each day
    rows.write.partitionBy("source_list", "publish_date").parquet(folder)
    landed = spark.read.parquet(folder)
    again = files.new_files(rows, landed.select("source_list", "publish_date", "digest"))
    return landed.unionByName(again).select(F.substring_index("digest", "-", 1).cast("long").alias("doc_id"), F.substring_index("digest", "-", -1).alias("digest"), F.sha2("content", 256).alias("stored"))


@query("select cast(c_custkey as varchar) as uid, 'Entity' as type, c_name as name, c_mktsegment as alias from customer")
def json_lines(read, spark):
    folder = f"{shared_folder(spark)}/json-{uuid.uuid4().hex}"
    files.write_json_lines(records_of(read), folder)
    return spark.read.schema("uid string, type string, name string, aliases array<string>").json(folder).select("uid", "type", "name", F.explode("aliases").alias("alias"))


@query("select event_type as source_list, event_id as seq, count(*) as n from (select event_type, event_id from events union all select event_type, event_id from events where event_id % 10 = 0) group by 1, 2 having count(*) > 1")
def activation_conflicts(read, spark):
    rows = activations(read)
    return versions.seq_conflicts(rows.unionByName(rows.where("seq % 10 = 0")))


# --- pages, search, screening -------------------------------------------------------------------


def searchable(read) -> DataFrame:
    talk = read("conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.col("text").alias("name")))).alias("a"))
    rows = read("customer").join(talk, F.col("c_custkey") == F.col("conv_id"), "left")
    rows = rows.select(text("c_custkey").alias("fixed_ref"), F.col("c_name").alias("primary_name"), F.coalesce(F.transform("a", lambda x: F.struct(x["name"].alias("name"))), F.array().cast("array<struct<name:string>>")).alias("aliases"))
    return search.with_search_columns(rows)


TALK_SQL = "t as (select conv_id, string_agg(text, chr(10) order by turn) as names from conversations group by 1), r as (select cast(c_custkey as varchar) as fixed_ref, c_name as primary_name, lower(coalesce(names, '')) as a from customer left join t on c_custkey = conv_id)"


@query(f"with {TALK_SQL} select fixed_ref, lower(primary_name) as primary_name_lower, a as alias_search from r")
def search_columns(read, spark):
    return searchable(read).select("fixed_ref", "primary_name_lower", "alias_search")


@query("select cast(c_custkey as varchar) as fixed_ref, c_name as primary_name from customer order by 1 limit 50 offset 100")
def list_page(read, spark):
    return search.page(searchable(read), 100, 50).select("fixed_ref", "primary_name")


@query("select cast(c_custkey as varchar) as fixed_ref, c_name as primary_name from customer where cast(c_custkey as varchar) > '12' order by 1 limit 50")
def list_page_after(read, spark):
    return search.page_after(searchable(read), "12", 50).select("fixed_ref", "primary_name")


@query(f"with {TALK_SQL} select fixed_ref, primary_name from r where contains(lower(primary_name), 'the') or contains(a, 'the') order by 1 limit 40 offset 5")
def search_page(read, spark):
    return search.page(search.search(searchable(read), "THE"), 5, 40).select("fixed_ref", "primary_name")


@query(f"with {TALK_SQL} select count(*) as total from r where contains(lower(primary_name), 'the') or contains(a, 'the')")
def page_total(read, spark):
    return search.total(search.search(searchable(read), "the"))


def indexed(read, spark) -> index.Index:
    """The searchable customers, written with their index."""
    folder = f"{shared_folder(spark)}/index-{uuid.uuid4().hex}"
    index.write(searchable(read), folder)
    return index.Index(spark, folder)


@query(f"with {TALK_SQL} select fixed_ref, primary_name from r where contains(lower(primary_name), 'the') or contains(a, 'the')")
def search_indexed(read, spark):
    """As search_page, through posting lists, and all hits."""
    return indexed(read, spark).search("THE").select("fixed_ref", "primary_name")


@query(f"with {TALK_SQL} select 'on' as query, fixed_ref from r where contains(lower(primary_name), 'on') or contains(a, 'on') union all select '0001', fixed_ref from r where contains(lower(primary_name), '0001') or contains(a, '0001')")
def search_indexed_short(read, spark):
    """A query that is shorter than a gram, and one of several grams."""
    held = indexed(read, spark)
    rows = [held.search(q).select(F.lit(q).alias("query"), "fixed_ref") for q in ("on", "0001")]
    return rows[0].unionByName(rows[1])


@query("select cast(c_custkey as varchar) as fixed_ref, c_name as primary_name from customer order by 1 limit 50 offset 100")
def list_page_indexed(read, spark):
    """As list_page, from the files that hold the page."""
    return indexed(read, spark).page(100, 50).select("fixed_ref", "primary_name")


SCREEN_SQL = "select d.doc_id, w.needle from documents d join (select lower(text) as needle from benchmark where trim(text) <> '' union select lower(n_name) from nation union select lower(r_name) from region) w on contains(lower(d.text), w.needle)"


def screened_names(read) -> DataFrame:
    return read("benchmark").select(F.col("text").alias("name")).union(read("nation").select("n_name")).union(read("region").select("r_name"))


@query(SCREEN_SQL)
def screen_batch(read, spark):
    return search.screen(read("documents"), "doc_id", "text", screened_names(read), "name")


@query(SCREEN_SQL)
def screen_indexed(read, spark):
    """As screen_batch, by a kept index of the texts' words, to which they are added in three batches, one of them twice."""
    held = index.TextIndex(spark, f"{shared_folder(spark)}/words-{uuid.uuid4().hex}")
    for k in (0, 1, 2, 1):
        held.add(read("documents").where(F.col("doc_id") % 3 == k), "doc_id", "text", f"part-{k}")
    return held.screen(read("documents"), "doc_id", "text", screened_names(read), "name")


@query("select c_custkey, lower(s) as needle from customer join (select distinct o_orderstatus as s from orders) on contains(lower(c_mktsegment), lower(s))")
def screen_short(read, spark):
    return search.screen(read("customer"), "c_custkey", "c_mktsegment", read("orders").select("o_orderstatus"), "o_orderstatus")


# --- comparison and statistics ------------------------------------------------------------------


@query("""select o_orderkey, case when o_orderkey % 10 = 0 then 'ADDED' when o_orderkey % 10 = 1 then 'REMOVED' else 'MODIFIED' end as change from orders where o_orderkey % 10 in (0, 1, 2)""")
def snapshot_diff(read, spark):
    o = read("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    k = F.col("o_orderkey") % 10
    return compare.diff(o.where(k != 0), o.where(k != 1).withColumn("o_totalprice", F.col("o_totalprice") + F.when(k == 2, 1).otherwise(0)), "o_orderkey")


@query("""with n as (select c_custkey, count(o_orderkey) as orders, count(distinct o_orderpriority) as priorities from customer left join orders on c_custkey = o_custkey group by 1)
select 'orders' as element, sum(orders)::bigint as total, avg(orders) as mean, max(orders) as most, count(*) filter (orders = 0) as without from n
union all select 'priorities', sum(priorities)::bigint, avg(priorities), max(priorities), count(*) filter (priorities = 0) from n""")
def profile_stats(read, spark):
    n = read("customer").join(read("orders"), F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("orders"), F.count_distinct("o_orderpriority").alias("priorities"))
    return compare.element_statistics(n, ["orders", "priorities"])


@query("select 'lang' as field, count(lang) as present, count(lang) / count(*) as share from documents union all select 'toxic', count(toxic), count(toxic) / count(*) from documents left join (select doc_id, max(toxic) as toxic from labels group by 1) using (doc_id)")
def field_presence(read, spark):
    labels = read("labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return compare.presence(read("documents").join(labels, "doc_id", "left"), ["lang", "toxic"])


@query("select count(*) as dates, count(*) filter (o_orderkey % 3 = 0 or o_orderkey % 7 = 0) as incomplete from orders where o_orderkey % 5 <> 0")
def birth_date_gaps(read, spark):
    k = F.col("o_orderkey")
    start = scalar.date_parts(F.when(k % 5 != 0, F.year("o_orderdate")), F.when(k % 3 != 0, F.month("o_orderdate")), F.when(k % 7 != 0, F.day("o_orderdate")))
    rows = read("orders").select(F.filter(F.array(scalar.partial_date(start, start)), lambda x: x.isNotNull()).alias("birth_dates"))
    return compare.incomplete_birth_dates(rows)


@query(f"with {PROGRAMS_SQL} select program, count(*) as records from programs group by 1")
def records_by_program(read, spark):
    return compare.by_program(customer_programs(read))


@query(f"with {PARTIES_SQL} select party_class as entity_type, count(*) as records from classified where party_class in ('Individual', 'Entity') group by 1")
def records_by_type(read, spark):
    return compare.by_type(scope.in_scope(parties(read)))


@query(f"with {PROGRAMS_SQL} select cast(o_custkey as varchar) as fixed_ref, c_name as primary_name, string_agg(program, '|' order by place) as programs from programs join customer on o_custkey = c_custkey group by all")
def record_api_shape(read, spark):
    rows = customer_programs(read).where(F.size("sanction_programs") > 0).join(read("customer"), F.col("pos") == F.col("c_custkey"))
    rows = rows.select(text("c_custkey").alias("fixed_ref"), F.col("c_name").alias("primary_name"), "sanction_programs")
    sent = shape.api_page(rows, 1, 0, 50).select(F.from_json("record", "fixedRef string, primaryName string, sanctionPrograms array<string>").alias("r"))
    return sent.select(F.col("r.fixedRef").alias("fixed_ref"), F.col("r.primaryName").alias("primary_name"), F.array_join("r.sanctionPrograms", "|").alias("programs"))


@query("select event_id, case when event_id % 4 = 0 then 0 when event_id % 4 = 1 then 0 else 2 end as n from events")
def json_arrays(read, spark):
    k = F.col("event_id") % 4
    given = F.when(k == 0, None).when(k == 1, " ").otherwise(F.concat(F.lit('[{"k":1},'), "props", F.lit("]")))
    return files.read_json_arrays(read("events").select("event_id", given.alias("a")), {"a": "array<struct<k:int>>"}).select("event_id", F.size("a").cast("long").alias("n"))


# --- whole paths: files, cycles, feeds ------------------------------------------------------------


@query("select s_suppkey, cast(1950 + s_suppkey % 100 as int) as year, cast(1 + s_suppkey % 12 as int) as month, case when s_suppkey % 3 > 0 then cast(1 + s_suppkey % 28 as int) end as day from supplier")
def xml_issued(read, spark):
    """The date of issue of many snapshots, one file for each supplier, with one entry; the last element counts, and a day may be missing.

    The files lie in one folder: a folder for each costs a task for each, whenever the path is listed.
    """
    folder = f"{shared_folder(spark)}/xml-{uuid.uuid4().hex}"
    k = F.col("s_suppkey")
    part = lambda name, value: element(name, {}, value.cast("string"))
    day = F.when(k % 3 > 0, part("Day", 1 + k % 28)).otherwise("")
    issued = F.concat(element("DateOfIssue", {}, part("Year", F.lit(1))), element("DateOfIssue", {}, part("Year", 1950 + k % 100), part("Month", 1 + k % 12), day))
    entry = element("SanctionsEntries", {}, element("SanctionsEntry", {"ID": k.cast("string")}))
    dealt(read("supplier").select("s_suppkey", element("Sanctions", {}, issued, entry).alias("value")), "s_suppkey").select("value").write.option("maxRecordsPerFile", 1).text(folder)
    found = xml.read_sections(spark, folder)
    return found["issued"].join(found["entries"], "snapshot_id").select(F.col("id").cast("long").alias("s_suppkey"), "year", "month", "day")


@query("""select cast(c_custkey as varchar) as fixed_ref, c_name as primary_name, case c_custkey % 4 when 0 then 'Individual' else 'Entity' end as entity_type,
case when c_custkey % 3 = 0 then c_mktsegment end as title, 'P' || c_nationkey || case when c_custkey % 5 = 0 then '|X' else '' end as programs from customer where c_custkey % 4 in (0, 1)""")
def csv_mapping(read, spark):
    """Customers as delimited party files, through the mapping's sections and the resolution that all sources share."""
    folder = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    k = F.col("c_custkey")
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    kind = F.when(k % 4 == 0, '"individual"').when(k % 4 == 1, "-0- ").when(k % 4 == 2, '"vessel"').otherwise('"aircraft"')
    programs = F.concat(F.lit("P"), "c_nationkey", F.when(k % 5 == 0, "] [X").otherwise(""))
    fields = [k.cast("string"), quoted(F.col("c_name")), kind, quoted(programs), F.when(k % 3 == 0, quoted(F.col("c_mktsegment"))).otherwise("-0- "), *[F.lit("-0- ")] * 7]
    read("customer").select(F.concat_ws(",", *fields)).write.text(folder)
    records = resolve.resolve(mapping.check_sections(mapping.csv_sections(spark, folder)))[0]
    return records.select("fixed_ref", "primary_name", "entity_type", "title", F.array_join("sanction_programs", "|").alias("programs"))


@query("select s_suppkey, length(s_name) + 3 as length, sha256('<' || s_name || '>' || chr(10)) as sum, sha256('<' || s_name || '>' || chr(10)) as restored from supplier")
def raw_chunks(read, spark):
    """One file for each supplier, taken in as chunks of 8 bytes: the digests of the manifest, and of the bytes put together again."""
    folder = f"{shared_folder(spark)}/raw-{uuid.uuid4().hex}"
    dealt(read("supplier").select("s_suppkey", F.concat(F.lit("<"), "s_name", F.lit(">")).alias("value")), "s_suppkey").write.partitionBy("s_suppkey").text(f"{folder}/in")
    held = chunks.take_in(spark, f"{folder}/in", folder, size=8)
    whole = held.chunks.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("number", "content"))).alias("parts"))
    whole = whole.select("path", F.sha2(F.aggregate("parts", F.lit(b""), lambda now, x: F.concat(now, x.content)), 256).alias("restored"))
    said = held.manifest.where(F.col("number") == chunks.WHOLE).join(whole, "path")
    return said.select(F.regexp_extract("path", r"s_suppkey=(\d+)/", 1).cast("long").alias("s_suppkey"), "length", "sum", "restored")


@query("""select cast(c_custkey as varchar) as fixed_ref, c_name as primary_name, case c_custkey % 3 when 0 then 'Individual' else 'Entity' end as entity_type, 'P' || c_nationkey as programs, '2026-08-20' as published
from customer where c_custkey % 3 < 2""")
def cycle_records(read, spark):
    """Customers as one snapshot, through the whole cycle: what readers see of the active version."""
    folder = f"{shared_folder(spark)}/cycle-{uuid.uuid4().hex}"
    key, c = text("c_custkey"), read("customer")
    kind = F.when(F.col("c_custkey") % 3 == 0, "4").when(F.col("c_custkey") % 3 == 1, "3").otherwise("1")
    identity = element("Identity", {"ID": key}, element("Alias", {"AliasTypeID": F.lit("1"), "Primary": F.lit("true")}, one_name(F.col("c_name"))))
    party = element("DistinctParty", {"FixedRef": key}, element("Profile", {"ID": key, "PartySubTypeID": kind}, identity))
    entry = element("SanctionsEntry", {"ID": key, "ProfileID": key, "ListID": F.lit("1")}, element("SanctionsMeasure", {"SanctionsTypeID": F.lit("1")}, element("Comment", {}, F.concat(F.lit("P"), "c_nationkey"))))
    day = "<DateOfIssue><Year>2026</Year><Month>8</Month><Day>20</Day></DateOfIssue>"
    marks = ["<Sanctions>" + day + "<DistinctParties>", None, "</DistinctParties><SanctionsEntries>", None, "</SanctionsEntries></Sanctions>"]
    lines = spark.createDataFrame([(k, m) for k, m in enumerate(marks) if m], "at int, value string")
    lines = lines.unionByName(c.select(F.lit(1).alias("at"), party.alias("value"))).unionByName(c.select(F.lit(3).alias("at"), entry.alias("value")))
    lines.coalesce(1).sortWithinPartitions("at").select("value").write.text(f"{folder}/in")
    path = spark.read.text(f"{folder}/in").inputFiles()[0]
    store = Store(spark, f"{folder}/store")
    outcome = cycle.run_cycle(spark, store, "SDN", path, chunks.digest_of(spark, path))
    rows = store.current("SDN") if outcome.status == "ACTIVATED" else store.current("SDN").limit(0)
    return rows.select("fixed_ref", "primary_name", "entity_type", F.array_join("sanction_programs", "|").alias("programs"), text("publish_date").alias("published"))


@query("""select 'SDN-1' as batch, cast(c_custkey as varchar) as fixed_ref, 'ADDED' as change from customer union all
select 'SDN-2', cast(c_custkey as varchar), case c_custkey % 10 when 0 then 'REMOVED' else 'MODIFIED' end from customer where c_custkey % 10 < 2 union all
select 'SDN-3', cast(c_custkey as varchar), case c_custkey % 10 when 0 then 'ADDED' else 'MODIFIED' end from customer where c_custkey % 10 < 2""")
def change_feed(read, spark):
    """Two versions activated, and a rollback, each followed twice: what each activation changed stands in the feed once."""
    folder = f"{shared_folder(spark)}/feed-{uuid.uuid4().hex}"
    store, rows, k = Store(spark, f"{folder}/store"), records_of(read), F.col("fixed_ref").cast("long") % 10
    new = rows.where(k != 0).withColumn("primary_name", F.concat("primary_name", F.when(k == 1, " II").otherwise("")))
    for digest, version in (("a", rows), ("b", new), (None, None)):
        if digest:
            store.put_isolated(version, **STORED, digest=digest, counts={"record_count": 0, "out_of_scope_count": 0, "expected_count": 0}, raw_path="-")
            store.activate(**STORED, digest=digest)
        else:
            store.rollback("SDN")
        for _ in range(2):
            ingest.append_changes(store, "SDN", f"{folder}/feed")
    return spark.read.parquet(f"{folder}/feed").select("batch", "fixed_ref", "change")


@query("""select cast(doc_id as varchar) as id, lower(n_name) as needle, case when n_nationkey < 12 then 1 else 2 end as seq from documents join nation on contains(lower(text), lower(n_name))""")
def watch_hits(read, spark):
    """Texts taken in two batches, one of them twice, against a list that grows after: each hit once, with the activation that brought it."""
    folder = f"{shared_folder(spark)}/watch-{uuid.uuid4().hex}"
    store, empty = Store(spark, f"{folder}/store"), {f.split(" ")[0]: f.split(" ", 1)[1] for f in schemas.top_level(schemas.RECORD_FIELDS)}
    held = watch.Watch(store, "SDN", folder)
    names = read("nation").select(text("n_nationkey").alias("fixed_ref"), F.col("n_name").alias("primary_name"))
    names = names.withColumns({c: F.lit(None).cast(kind) for c, kind in empty.items() if c not in names.columns})
    for digest, rows in (("a", names.where("fixed_ref < 12")), ("b", names)):
        store.put_isolated(rows, **STORED, digest=digest, counts={"record_count": 0, "out_of_scope_count": 0, "expected_count": 0}, raw_path="-")
    store.activate(**STORED, digest="a")
    for part in (0, 1, 0):
        held.take(read("documents").where(F.col("doc_id") % 2 == part), "doc_id", "text", f"part-{part}")
    store.activate(**STORED, digest="b")
    held.catch_up()
    return held.hits()


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Which parties in scope match a name: parsed from XML, named, deduplicated, searched."""
    read = lambda table: spark.read.parquet(f"{folder}/{table}.parquet")
    rows = scope.in_scope(party_rows(read))
    labels = spark.createDataFrame([("s", "AliasType", "1400", "A.K.A.")], "snapshot_id string, kind string, id string, label string")
    rows = rows.drop("aliases", "features").join(resolve.resolve_names(rows, labels), ["snapshot_id", "pos"])
    found = search.search(search.with_search_columns(dedup.dedup_within(rows)), "customer")
    return search.page(found, 0, 1000).select("fixed_ref", "entity_type", "primary_name")
