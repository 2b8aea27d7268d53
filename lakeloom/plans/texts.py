"""Strings, JSON, keys, codes, course identifiers, conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes, course_ids, json_text, keys
from ..operators import conversations
from .catalog import query
from .tables import table


@query("""
    select event_id, json_extract_string(props, '$.k') as k, json_extract_string(props, '$.none') as none, starts_with(props, '{') as is_object from events
""")
def json_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", json_text.json_scalar("props", "$.k").alias("k"), json_text.json_string("props", "$.none").alias("none"), json_text.is_json_object("props").alias("is_object"))


@query("select event_id, 'k' as key, json_extract_string(props, '$.k') as value from events where json_extract_string(props, '$.k') is not null")
def json_map_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each entry of a JSON object."""
    return json_text.unnested_map(table(spark, sf_dir, "events").select("event_id", "props"), "props").select("event_id", "key", F.col("value"))


@query("""
    with a as (select event_id, '["' || event_type || '", "x", "' || user_id || '"]' as items from events)
    select event_id, i as position, json_extract_string(items, '$[' || (i - 1) || ']') as element from a cross join (select unnest([1, 2, 3]) as i)
""")
def json_array_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements with 1-based positions."""
    items = F.to_json(F.array("event_type", F.lit("x"), F.col("user_id").cast("string")))
    return json_text.unnested_array(table(spark, sf_dir, "events").select("event_id", items.alias("items")), "items", "element", "position").select("event_id", "position", "element")


@query("""
    select c_custkey, md5(c_custkey::varchar || '-' || coalesce(nullif(c_mktsegment, 'BUILDING'), '_dbt_utils_surrogate_key_null_')) as surrogate, sha256(c_name) as hashed,
        sha256(c_custkey::varchar || coalesce(nullif(c_mktsegment, 'BUILDING'), '')) as row_hash, trim(regexp_replace(lower(c_name), '[^a-z0-9]+', '_', 'g'), '_') as slug
    from customer
""")
def derived_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").withColumn("segment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    return rows.select("c_custkey", keys.surrogate_key("c_custkey", "segment").alias("surrogate"), keys.hash_id("c_name").alias("hashed"), keys.row_hash("c_custkey", "segment").alias("row_hash"), keys.slugify("c_name").alias("slug"))


@query("""
    with a as (select p_partkey, 'course-v1:Org' || p_size || '+' || replace(p_brand, '#', '') || '+' || p_type as v1 from part)
    select p_partkey, replace(replace(v1, 'course-v1:', ''), '+', '/') as slashes, v1 as again, regexp_replace(v1, '\\+[^+]*$', '') as course, split_part(v1, '+', 3) as run,
        case when v1 like 'course-v1:Org1%' then 'one' when v1 like 'course-v1:Org2%' then 'two' else 'other' end as platform, v1 as found
    from a
""")
def course_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys between notations, and out of a tracking event's context, path, type and page."""
    v1 = F.concat(F.lit("course-v1:Org"), F.col("p_size").cast("string"), F.lit("+"), F.replace("p_brand", F.lit("#"), F.lit("")), F.lit("+"), F.col("p_type"))
    rows = table(spark, sf_dir, "part").select("p_partkey", v1.alias("v1"))
    context = F.when(F.col("p_partkey") % 3 == 0, F.to_json(F.struct(F.col("v1").alias("course_id")))).when(F.col("p_partkey") % 3 == 1, F.to_json(F.struct(F.concat(F.lit("/courses/"), "v1", F.lit("/info")).alias("path"))))
    return rows.select(
        "p_partkey",
        course_ids.to_slashes("v1").alias("slashes"),
        course_ids.to_v1(course_ids.to_slashes("v1")).alias("again"),
        course_ids.without_run("v1").alias("course"),
        course_ids.run_tag("v1").alias("run"),
        course_ids.platform_of("v1", {"course-v1:Org1": "one", "course-v1:Org2": "two"}, "other").alias("platform"),
        course_ids.course_of_event(context, F.lit("page"), F.concat(F.lit("https://x/courses/"), "v1", F.lit("/course"))).alias("found"),
    )


@query("""
    select p_partkey, case p_size % 4 when 0 then 'Male' when 1 then 'Female' when 2 then null else 'Other/Prefer Not to Say' end as gender,
        case when p_partkey % 3 = 0 then 'Known' when p_type = 'ECONOMY' then 'Document' when p_type = 'STANDARD' then 'Image' else 'Other' end as resource_type,
        nullif(regexp_extract(p_brand, '#([0-9]+)$', 1), '') as brand_number, upper(substring(p_name, 1, 1) || substring(split_part(p_name, ' ', 2), 1, 1)) as acronym,
        array_to_string([upper(w) for w in string_split(p_name, ' ')], '+') as shouted, instr(p_name, ' ')::integer as first_space
    from part
""")
def labels_and_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.element_at(F.array(F.lit("m"), F.lit("f"), F.lit("?"), F.lit("o")), F.col("p_size") % 4 + 1)
    url = F.when(F.col("p_type") == "ECONOMY", "http://x/a.PDF").when(F.col("p_type") == "STANDARD", "http://x/b.png").otherwise("http://x/c")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        codes.label(code, codes.GENDER).alias("gender"),
        codes.resource_type(url, F.when(F.col("p_partkey") % 3 == 0, F.lit("Known"))).alias("resource_type"),
        course_ids.found("p_brand", "#([0-9]+)$").alias("brand_number"),
        course_ids.acronym("p_name").alias("acronym"),
        F.array_join(F.transform(F.split("p_name", " "), F.upper), "+").alias("shouted"),
        F.instr("p_name", " ").alias("first_space"),
    )


@query("""
    select conv_id, string_agg(coalesce(role, '') || ': ' || coalesce(text, ''), chr(10) order by turn, role, coalesce(role, '') || ': ' || coalesce(text, '')) as conversation_text, count(*) as n_turns
    from conversations group by conv_id
""")
def conversation_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns joined in order."""
    line = F.concat(F.coalesce("role", F.lit("")), F.lit(": "), F.coalesce("text", F.lit("")))
    return conversations.assembled(table(spark, sf_dir, "conversations"), "conv_id", ["turn", "role"], line)


@query("""
    select conv_id, turn, row_number() over (partition by conv_id order by turn nulls last, text nulls last) as turn_number,
        row_number() over (partition by conv_id order by turn nulls last, text nulls last) = 1 as is_opening
    from conversations where role = 'user'
""")
def opening_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user's turns, numbered, the first marked."""
    turns = conversations.numbered(table(spark, sf_dir, "conversations"), "conv_id", ["turn", "text"], F.col("role") == "user")
    return turns.select("conv_id", "turn", F.col("turn_number").cast("long").alias("turn_number"), "is_opening")


@query("""
    with a as (select * from conversations qualify row_number() over (partition by conv_id, role, text order by turn nulls first) = 1)
    select conv_id, turn, role, row_number() over (partition by conv_id order by turn nulls first, text nulls first, role nulls first) as message_number from a
""")
def transcript_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated messages (of equal role and text) go, the rest is numbered anew."""
    kept = conversations.without_repeats(table(spark, sf_dir, "conversations"), "conv_id", ["turn", "text", "role"], ["role", "text"])
    return kept.select("conv_id", "turn", "role", F.col("message_number").cast("long").alias("message_number"))


@query("""
    with twice as (select * from conversations union all select * from conversations),
        a as (select * from twice qualify row_number() over (partition by conv_id, role, text order by turn nulls first) = 1)
    select conv_id, turn, role, text, row_number() over (partition by conv_id order by turn nulls first, text nulls first, role nulls first) as message_number from a
""")
def transcript_dedup_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated messages (of equal role and whole text; here each is there twice) go, the rest is numbered anew."""
    rows = table(spark, sf_dir, "conversations")
    kept = conversations.without_repeats(rows.unionByName(rows), "conv_id", ["turn", "text", "role"], ["role", "text"])
    return kept.select("conv_id", "turn", "role", "text", F.col("message_number").cast("long").alias("message_number"))


@query("""
    with t as (select conv_id, turn, lower(trim(w)) as tag from (select conv_id, turn, unnest(string_split(text, ' ')) as w from conversations) where trim(w) <> ''),
        n as (select tag, count(*) as n from t group by tag)
    select conv_id, tag as dominant_tag from (select distinct conv_id, tag from t) join n using (tag) qualify row_number() over (partition by conv_id order by n desc, tag) = 1
""")
def dominant_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a conversation's tags (the words of its turns), the most frequent in the corpus."""
    tagged = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.split("text", " ").alias("tags"))
    return conversations.dominant(conversations.exploded_tags(tagged, "tags", "tag"), "conv_id", "tag")


@query("""
    select n_regionkey, string_agg(n_nationkey::varchar || '|' || n_name || '|', ';' order by n_nationkey, n_nationkey::varchar || '|' || n_name || '|') as packed from nation group by n_regionkey
""")
def packed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a key in one string."""
    from ..operators import reports

    rows = table(spark, sf_dir, "nation").withColumn("none", F.lit(None).cast("string"))
    return reports.packed(rows, ["n_regionkey"], ["n_nationkey"], ["n_nationkey", "n_name", "none"])
