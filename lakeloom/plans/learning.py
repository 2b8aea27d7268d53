"""Reports on learners, courses and programs that join several sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import facts, hierarchy, identity, incremental, joins, reports, trees
from .catalog import query
from .tables import table


@query("""
    with op as (
            select n_nationkey * 10 + r as id, case r % 2 when 0 then 'all_of' else 'min_number_of' end as rule, r + 1 as least, n_name || '/' || r as title,
                lpad(n_nationkey::varchar, 8, '0') || case when r >= 3 then '00000002' else '' end || lpad((r + 1)::varchar, 8, '0') as path
            from nation cross join (select unnest(range(5)) as r)
        ),
        co as (
            select s_suppkey as course, s_nationkey as program, lpad(s_nationkey::varchar, 8, '0') || case when s_suppkey % 6 = 5 then '00000009' else case when s_suppkey % 6 >= 3 then '00000002' else '' end || lpad((s_suppkey % 6 + 1)::varchar, 8, '0') end
                || lpad(s_suppkey::varchar, 8, '0') as path
            from supplier
        ),
        near as (select co.*, op.* exclude (path), op.path as stem, row_number() over (partition by course, program order by length(op.path) desc, op.id desc) as k from co left join op on starts_with(co.path, op.path)),
        one as (select a.*, b.id as above from near a left join near b on a.course = b.course and a.program = b.program and b.k = 2 and starts_with(a.stem, b.stem) where a.k = 1),
        core as (select program, count(*) filter (where rule = 'all_of') as n from one group by program),
        elective as (select program, sum(least) as n from (select distinct program, id, least from one where rule = 'min_number_of' and above is null) group by program)
    select course as course_id, one.program as program_id, id as requirement_id, case rule when 'all_of' then 'Core' when 'min_number_of' then 'Elective' end as kind, title, least, above as parent_id,
        (core.n + coalesce(elective.n, 0))::bigint as n_required, row_number() over (partition by one.program order by path, course) as place, above is not null as is_nested
    from one join core using (program) left join elective using (program)
""")
def program_requirements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Programs (here: nations) with sets of requirements, some of them nested, and the courses (here: suppliers) that count for them."""
    step = lambda c: F.lpad(c.cast("string"), 8, "0")
    nested = lambda c: F.when(c >= 3, "00000002").otherwise("")
    r, own = F.col("r"), F.col("s_suppkey") % 6
    operators = table(spark, sf_dir, "nation").withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(4)))).select(
        (F.col("n_nationkey") * 10 + r).alias("operator_id"),
        F.concat(step(F.col("n_nationkey")), nested(r), step(r + 1)).alias("path"),
        F.when(r % 2 == 0, "all_of").otherwise("min_number_of").alias("rule"),
        (r + 1).alias("least"),
        F.concat_ws("/", "n_name", r.cast("string")).alias("title"),
    )
    place = F.when(own == 5, F.lit("00000009")).otherwise(F.concat(nested(own), step(own + 1)))
    nodes = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("course_id"), F.col("s_nationkey").alias("program_id"), F.concat(step(F.col("s_nationkey")), place, step(F.col("s_suppkey"))).alias("path"))
    return hierarchy.requirement_tree(operators, nodes, 8).withColumn("place", F.col("place").cast("long"))


def _content() -> list[tuple]:
    """(course, block_id, parent_id, chapter_id, sequential_id, title, metadata, is_latest) of three courses, with old versions."""
    titles = ["Week one", "Example exams", "Midterm exam", "Practice exam", "The FINAL EXAM, part 1", "Examining", None, "Exam A"]
    homework, other = '{"format":"Homework"}', '{"format":"Lab"}'
    rows = []
    for course in range(3):
        rows += [(course, f"p{b}", f"u{b // 3}", f"c{b // 12}", f"s{b // 6}", f"Problem {b}", homework if b % 8 == 0 else other, True) for b in range(23)]
        rows += [(course, f"u{u}", f"s{u // 2}", f"c{u // 4}", f"s{u // 2}", title, None if u == 5 else other, True) for u, title in enumerate(titles)]
        rows += [(course, f"s{s}", f"c{s // 2}", f"c{s // 2}", None, f"Sequence {s}", homework if s == 1 else other, True) for s in range(4)]
        rows += [(course, f"c{c}", None, None, None, ["Start", "End of term exam "][c], other, True) for c in range(2)]
        rows += [(course, f"u{u}", "s9", "c9", "s9", "Old final exam", homework, False) for u in range(8)]
    return rows


_CONTENT_COLUMNS = "course, block_id, parent_id, chapter_id, sequential_id, title, metadata, is_latest"


def _shown(value: object) -> str:
    return "null" if value is None else str(value).lower() if isinstance(value, bool) else str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"


_CONTENT_SQL = f"content({_CONTENT_COLUMNS}) as (values {', '.join('(' + ', '.join(map(_shown, r)) + ')' for r in _content())})"


def _content_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_content(), "course long, block_id string, parent_id string, chapter_id string, sequential_id string, title string, metadata string, is_latest boolean")


@query(f"""
    with {_CONTENT_SQL},
        attempts as (
            select event_id, case event_id % 2 when 0 then 'a' else 'b' end as platform, user_id, event_id % 3 as course, 'p' || (floor(value)::bigint % 24) as block, ts as moment,
                case when event_id % 9 <> 0 then (event_id % 5) / 4.0 end::double as grade, 1.0::double as max_grade, event_id % 4 + 1 as attempt
            from events
        ),
        paid as (select user_id, event_id % 3 as course, max(value) as course_grade from events group by all having count(*) filter (where user_id % 5 <> 0 and event_id % 2 = 0) > 0),
        joined as (
            select a.*, course_grade, u.title as unit_name, c.title as chapter_name, s.title as sequential_name, p.metadata as m1, u.metadata as m2, s.metadata as m3,
                epoch_us(moment) - epoch_us(lag(moment) over (partition by platform, a.user_id, a.course, p.parent_id order by moment, event_id)) as us
            from attempts a join paid on a.user_id = paid.user_id and a.course = paid.course
                left join content p on p.course = a.course and p.block_id = block and p.is_latest
                left join content u on u.course = a.course and u.block_id = p.parent_id and u.is_latest
                left join content c on c.course = a.course and c.block_id = p.chapter_id and c.is_latest
                left join content s on s.course = a.course and s.block_id = p.sequential_id and s.is_latest
        ),
        told as (
            select *, us // 1000000 as gap, coalesce(unit_name ilike '%final exam%' or chapter_name ilike '%final exam%', false) as is_final,
                coalesce((unit_name ilike '%exam%' and unit_name not ilike '%example%' and unit_name not ilike '%examining%' and unit_name not ilike '%practice%')
                    or (chapter_name ilike '%exam%' and chapter_name not ilike '%example%' and chapter_name not ilike '%examining%' and chapter_name not ilike '%practice%')
                    or unit_name ilike '%exam %' or chapter_name ilike '%exam %', true) as is_exam,
                coalesce(m1 like '%"format":"Homework"%' or m2 like '%"format":"Homework"%' or m3 like '%"format":"Homework"%', true) as is_homework
            from joined
        ),
        problems as (
            select platform, course, user_id, block, unit_name, chapter_name, sequential_name, is_exam, is_homework, is_final, max(max_grade) as possible, max(attempt) as attempts, max(grade) as best,
                coalesce(string_agg(grade::varchar, ',' order by grade::varchar), '') as grades, min(case when gap < 600 then gap end) as seconds, min(gap) as seconds_unlimited, max(course_grade) as course_grade
            from told group by all
        ),
        fast as (select platform, course, block, quantile_cont(seconds, 0.1) as limit_10 from problems group by all),
        learners as (
            select platform, course, user_id, avg(case when is_homework then best::decimal(12, 2) end) as homework_grade, quantile_cont(case when is_homework then seconds end, 0.5) as homework_seconds,
                sum(case when is_homework then attempts end)::bigint as homework_attempts, avg(case when is_exam then best::decimal(12, 2) end) as exam_grade, quantile_cont(case when is_exam then seconds end, 0.5) as exam_seconds,
                sum(case when is_exam then coalesce(seconds < limit_10, false)::bigint end)::bigint as exam_flags, nullif(count(distinct case when not is_exam then block end), 0) as n_other, bool_or(is_final) as took_final
            from problems join fast using (platform, course, block) group by all
        )
    select problems.* exclude (is_final), homework_grade, homework_seconds, homework_attempts, exam_grade, exam_seconds, exam_flags, n_other, took_final from problems join learners using (platform, course, user_id)
""")
def answer_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full report on how fast verified learners answer: exams and homework told apart, tenth of the fastest, flags."""
    events = table(spark, sf_dir, "events")
    course, n = F.col("event_id") % 3, F.col("event_id")
    attempts = events.select(
        "event_id",
        F.when(n % 2 == 0, "a").otherwise("b").alias("platform"),
        "user_id",
        course.alias("course"),
        F.concat(F.lit("p"), (F.floor("value") % 24).cast("string")).alias("block"),
        F.col("ts").alias("at"),
        F.when(n % 9 != 0, (n % 5) / 4.0).cast("double").alias("grade"),
        F.lit(1.0).alias("max_grade"),
        (n % 4 + 1).alias("attempt"),
    )
    mode = F.when((F.col("user_id") % 5 != 0) & (n % 2 == 0), "verified").otherwise("audit")
    enrolments = events.select("user_id", course.alias("course"), mode.alias("mode"), F.col("value").alias("grade"))
    return reports.answer_report(attempts, enrolments, _content_table(spark))


@query("""
    with logs as (select user_id, floor(value / 10)::bigint as problem, event_id % 3 as attempt, case event_type when 'click' then 'problem_check' else 'showanswer' end as kind, ts, event_id, 'log' as source from events where event_type in ('click', 'view')),
        states as (
            select user_id, floor(value / 10)::bigint as problem, event_id % 3 as attempt, 'problem_check' as kind, ts, event_id, 'state' as source from events where event_type = 'purchase'
            qualify row_number() over (partition by user_id, problem, attempt order by ts desc nulls last, event_id desc) = 1
        )
    select event_id, user_id, problem, attempt, kind, source from (select * from logs union all select * from states)
    qualify kind <> 'problem_check' or row_number() over (partition by user_id, problem, attempt order by ts, event_id) = 1
""")
def problem_events_with_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks and shown answers from logs, and checks from the history of module states, each attempt once."""
    rows = table(spark, sf_dir, "events").select("event_type", "user_id", F.floor(F.col("value") / 10).alias("problem"), (F.col("event_id") % 3).alias("attempt"), "ts", "event_id")
    kind = F.when(F.col("event_type") == "click", "problem_check").otherwise("showanswer")
    logs = rows.where("event_type in ('click', 'view')").select("*", kind.alias("kind"), F.lit("log").alias("source"))
    history = rows.where("event_type = 'purchase'").withColumn("source", F.lit("state"))
    out = facts.problem_events(logs, history, ["user_id", "problem"], "attempt", "kind", "problem_check", "ts", "event_id")
    return out.select("event_id", "user_id", "problem", "attempt", "kind", "source")


@query("""
    with c as (
            select event_id // 2 as id, case event_type when 'purchase' then 'campus' else 'partner' end as platform, case event_id % 3 when 0 then 'program' else 'run' end as scope, case when event_id % 9 <> 0 then user_id end as who, event_id % 13 as run,
                ts as created, case when event_id % 4 = 0 then ts + interval 2 day end as updated, event_id from events where event_type in ('purchase', 'click')
        ),
        one as (
            select *, coalesce(updated, created) as moment from c
            qualify row_number() over (partition by case when who is not null then 'k|' || who || '|' || run else 'i|' || platform || '|' || id end order by case platform when 'campus' then 0 else 1 end, coalesce(updated, created) desc nulls last, id) = 1
        ),
        last as (select * from one qualify row_number() over (partition by id, platform, scope order by moment desc nulls last, who desc nulls last, run desc nulls last) = 1),
        marks as (select platform, scope, max(coalesce(updated, created)) as mark from c where created <= timestamp '2024-01-15' and platform = 'campus' group by all)
    select md5(id || '-' || platform || '-' || scope) as certificate_key, id, platform, scope, who, run from last left join marks using (platform, scope) where mark is null or moment >= mark
""")
def certificate_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Certificates of two platforms: one of each person and run, then one of each key, then what is newer than the marks of platform and scope."""
    n = F.col("event_id")
    rows = table(spark, sf_dir, "events").where("event_type in ('purchase', 'click')").select(
        F.expr("event_id div 2").alias("id"),
        F.when(F.col("event_type") == "purchase", "campus").otherwise("partner").alias("platform"),
        F.when(n % 3 == 0, "program").otherwise("run").alias("scope"),
        F.when(n % 9 != 0, F.col("user_id")).alias("who"),
        (n % 13).alias("run"),
        F.col("ts").alias("created"),
        F.when(n % 4 == 0, F.col("ts") + F.expr("interval 2 days")).alias("updated"),
    )
    moved = lambda df: df.withColumn("at", F.coalesce("updated", "created"))
    known = moved(rows.where("created <= timestamp_ntz'2024-01-15 00:00:00' and platform = 'campus'"))
    out = facts.certificates(rows, ["who", "run"], "id", "platform", "scope", ["campus", "partner"], "updated", "created")
    newer = incremental.after_watermark(moved(out), known, "at", inclusive=True, by=["platform", "scope"])
    return newer.select("certificate_key", "id", "platform", "scope", "who", "run")


@query("""
    with product as (select p_partkey as product, p_size % 2 as platform, case when p_partkey % 2 = 0 then p_partkey % 40 end as run, case when p_partkey % 2 = 1 then p_partkey % 15 end as program from part),
        line as (select l_orderkey as order_id, l_linenumber as line_id, o_custkey as person, l_partkey as product, p_size % 2 as platform, o_orderdate as updated, l_suppkey from lineitem join orders on l_orderkey = o_orderkey join part on p_partkey = l_partkey),
        enrolment as (select event_id as enrolment, event_id % 2 as platform, user_id as person, event_id % 40 as run, event_id % 15 as program, case when event_id % 4 < 2 then event_id end as order_id from events where event_type = 'signup'),
        own as (
            select enrolment, l.order_id, line_id, updated, case when p.run = e.run then 1 when p.program = e.program then 2 else 3 end as priority, false as inferred
            from enrolment e join line l on l.order_id = e.order_id and l.platform = e.platform left join product p on p.product = l.product
        ),
        guess as (
            select enrolment, l.order_id, line_id, updated, case when p.run = e.run then 1 else 2 end as priority, true as inferred
            from enrolment e join line l on l.person = e.person and l.platform = e.platform join product p on p.product = l.product and p.platform = e.platform and (p.run = e.run or p.program = e.program)
            where not exists (select 1 from own where own.enrolment = e.enrolment) and not (e.platform = 0 and e.order_id is null)
        )
    select enrolment, order_id, line_id, inferred from (select * from own union all select * from guess) qualify row_number() over (partition by enrolment order by priority, updated desc nulls last, order_id desc nulls last, line_id desc nulls last) = 1
""")
def enrolment_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order behind each enrolment: its own, or one inferred from what the same person bought."""
    k, n = F.col("p_partkey"), F.col("event_id")
    parts = table(spark, sf_dir, "part").withColumn("platform", (F.col("p_size") % 2).cast("long"))
    products = parts.select(k.alias("product"), "platform", F.when(k % 2 == 0, k % 40).alias("run"), F.when(k % 2 == 1, k % 15).alias("program"))
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(parts.select(k, "platform"), F.col("l_partkey") == k)
    lines = lines.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_id"), "platform", F.col("o_custkey").alias("person"), F.col("l_partkey").alias("product"), F.col("o_orderdate").alias("updated"))
    enrolments = table(spark, sf_dir, "events").where("event_type = 'signup'").select(n.alias("enrolment"), (n % 2).alias("platform"), F.col("user_id").alias("person"), (n % 40).alias("run"), (n % 15).alias("program"), F.when(n % 4 < 2, n).alias("order_id"))
    return identity.enrolment_orders(enrolments, lines, products, [0])


@query("""
    with rows as (select user_id, event_id % 3 as course, (floor(value)::bigint % 24) as b, event_type, value, event_id from events),
        t as (select b, 'Section ' || b // 12 as section, 'Subsection ' || b // 6 as subsection, case when b // 3 <> 6 then 'Unit ' || b // 3 end as unit from (select unnest(range(23)) as b)),
        l as (select user_id, course, section, subsection, unit, event_type, value, event_id from rows left join t using (b)),
        keys as (select distinct user_id, course, section, subsection, unit from l where event_type in ('click', 'view', 'purchase', 'error')),
        pages as (select user_id, course, section, subsection, unit, count(*) as page_views from l where event_type = 'click' group by all),
        videos as (select user_id, course, section, subsection, unit, count(*) as videos, count(*) filter (where event_id % 3 = 0) as rewatched from l where event_type = 'view' group by all),
        tasks as (select user_id, course, section, subsection, unit, count(*) as attempted, count(*) filter (where value > 50) as correct from l where event_type = 'purchase' group by all),
        posts as (select user_id, course, section, subsection, unit, count(*) as posts from l where event_type = 'error' group by all)
    select k.*, page_views, videos, rewatched, attempted, correct, posts from keys k
        left join pages a on (k.user_id, k.course) = (a.user_id, a.course) and k.section is not distinct from a.section and k.subsection is not distinct from a.subsection and k.unit is not distinct from a.unit
        left join videos b on (k.user_id, k.course) = (b.user_id, b.course) and k.section is not distinct from b.section and k.subsection is not distinct from b.subsection and k.unit is not distinct from b.unit
        left join tasks c on (k.user_id, k.course) = (c.user_id, c.course) and k.section is not distinct from c.section and k.subsection is not distinct from c.subsection and k.unit is not distinct from c.unit
        left join posts d on (k.user_id, k.course) = (d.user_id, d.course) and k.section is not distinct from d.section and k.subsection is not distinct from d.subsection and k.unit is not distinct from d.unit
""")
def engagement_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views, videos, problems and posts side by side, by learner and the section, subsection and unit above each block."""
    rows = table(spark, sf_dir, "events").select("user_id", (F.col("event_id") % 3).alias("course"), (F.floor("value") % 24).alias("b"), "event_type", "value", "event_id")
    above = lambda name, n: F.concat(F.lit(name), F.expr(f"b div {n}").cast("string")).alias(name.strip().lower())
    unit = F.when(F.expr("b div 3") != 6, F.concat(F.lit("Unit "), F.expr("b div 3").cast("string"))).alias("unit")
    content = spark.range(23).select(F.col("id").alias("b")).select("b", above("Section ", 12), above("Subsection ", 6), unit)
    of, one = (lambda kind: rows.where(F.col("event_type") == kind)), F.lit(1)
    streams = {
        "pages": (of("click"), {"page_views": one}),
        "videos": (of("view"), {"videos": one, "rewatched": (F.col("event_id") % 3 == 0).cast("int")}),
        "problems": (of("purchase"), {"attempted": one, "correct": (F.col("value") > 50).cast("int")}),
        "posts": (of("error"), {"posts": one}),
    }
    return reports.engagement(streams, content, ["user_id", "course"], "b", ["section", "subsection", "unit"])


@query("""
    with n as (select r_regionkey as r, null as c, 'r' || r_regionkey as block_id, 'course' as block_parent, 'chapter' as block_type, r_name as block_title from region
            union all select n_regionkey, n_nationkey, 'n' || n_nationkey, 'r' || n_regionkey, 'sequential', n_name from nation),
        i as (select *, 1 + row_number() over (order by r, c nulls first) as place from n)
    select 'course-v1:World+T+1' as course_id, 'The world' as course_title, block_id, place::integer as block_index, block_parent, block_type, block_title from i
    union all select 'course-v1:World+T+1', 'The world', 'course', 1, null, 'course', 'The world'
    union all select 'course-v1:World+T+1', 'The world', 'stray', 0, null, 'problem', 'Left over'
""")
def course_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The blocks of a course document (here: regions as chapters, nations as sequentials) in the order of learners, from 1."""
    course, region, nation = F.lit("course"), table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    block = lambda id_, kind, title: [id_.alias("node"), F.lit(kind).alias("block_type"), title.alias("block_title")]
    one = spark.range(1)
    chapters = region.select(*block(F.concat(F.lit("r"), "r_regionkey"), "chapter", F.col("r_name")))
    leaves = nation.select(*block(F.concat(F.lit("n"), "n_nationkey"), "sequential", F.col("n_name")))
    blocks = one.select(*block(course, "course", F.lit("The world"))).union(one.select(*block(F.lit("stray"), "problem", F.lit("Left over")))).union(chapters).union(leaves)
    below = region.select(course.alias("node"), F.concat(F.lit("r"), "r_regionkey").alias("child"), F.col("r_regionkey").alias("place"))
    below = below.union(nation.select(F.concat(F.lit("r"), "n_regionkey"), F.concat(F.lit("n"), "n_nationkey"), "n_nationkey"))
    below = below.union(one.select(course, F.lit("gone"), F.lit(1 << 30)))
    of = lambda df: df.withColumn("tree", F.lit("course-v1:World+T+1"))
    found = trees.depth_first(of(blocks).withColumn("is_root", F.col("block_type") == "course"), of(below))
    named = found.withColumnRenamed("tree", "course_id").join(blocks, "node")
    return named.select("course_id", F.lit("The world").alias("course_title"), F.col("node").alias("block_id"), F.col("index").cast("int").alias("block_index"), F.col("parent").alias("block_parent"), "block_type", "block_title")


@query("""
    with n as (
        select r_regionkey as t, null::bigint as c, null::bigint as o, 'r' || r_regionkey as node, null as parent from region
        union all select n_regionkey, c_custkey, null, 'c' || c_custkey, 'r' || n_regionkey from customer join nation on n_nationkey = c_nationkey
        union all select n_regionkey, c_custkey, o_orderkey, 'o' || o_orderkey, 'c' || c_custkey from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey
    )
    select t as tree, node, parent, row_number() over (partition by t order by c nulls first, o nulls first) as index from n
""")
def nested_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth-first places of customers and orders below their region: a tree for each, none held by one task."""
    customers = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    orders = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    node = lambda mark, c: F.concat(F.lit(mark), F.col(c).cast("string"))
    nodes = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("tree"), node("r", "r_regionkey").alias("node"), F.lit(True).alias("is_root"))
    nodes = nodes.union(customers.select("n_regionkey", node("c", "c_custkey"), F.lit(False))).union(orders.select("n_regionkey", node("o", "o_orderkey"), F.lit(False)))
    below = customers.select(F.col("n_regionkey").alias("tree"), node("r", "n_regionkey").alias("node"), node("c", "c_custkey").alias("child"), F.col("c_custkey").alias("place"))
    below = below.union(orders.select("n_regionkey", node("c", "c_custkey"), node("o", "o_orderkey"), "o_orderkey"))
    return trees.depth_first(nodes, below)


@query("""
    select distinct lower(trim(' ' || c_name || '@X.org ')) as email from customer where c_acctbal > 0
""")
def onboarding_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of those admitted, lower-cased, once each."""
    people = table(spark, sf_dir, "customer").withColumn("address", F.concat(F.lit(" "), "c_name", F.lit("@X.org ")))
    return facts.onboarding_list(people, "address", F.col("c_acctbal") > 0)


@query("""
    with g as (select lower(trim(c_mktsegment)) || c_nationkey as k, c_acctbal as joined, c_custkey as tie, case when c_custkey % 3 = 0 then c_name end as name, case when c_custkey % 2 = 0 then c_nationkey end as country from customer)
    select k, (select name from g h where h.k = g.k and name is not null order by joined desc nulls last, tie desc limit 1) as name, (select country from g h where h.k = g.k and country is not null order by joined desc nulls last, tie desc limit 1) as country
    from g group by k
""")
def survivorship_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each attribute the newest value that is known."""
    rows = table(spark, sf_dir, "customer").select(
        F.concat(F.lower(F.trim("c_mktsegment")), F.col("c_nationkey").cast("string")).alias("k"),
        F.col("c_acctbal").alias("joined"),
        F.col("c_custkey").alias("tie"),
        F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).alias("name"),
        F.when(F.col("c_custkey") % 2 == 0, F.col("c_nationkey")).alias("country"),
    )
    return identity.filled_in(rows, "k", "joined", "tie", ["name", "country"])


@query("""
    with modules as (select distinct user_id * 100 + floor(value)::bigint % 24 as module, user_id as person, user_id % 3 as course, 'p' || floor(value)::bigint % 24 as block from events where event_id % 10 <> 0)
    select person, course, block, strftime(ts, '%Y-%m-%d %H:%M:%S') as at, (event_id % 4 + 1)::integer as attempt, (event_id % 3) / 2.0::double as grade, 1.0::double as max_grade, event_id % 3 = 2 as is_correct
    from events join modules on module = user_id * 100 + floor(value)::bigint % 24 where event_id % 5 <> 0
""")
def module_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histories of states joined to the modules that they are of."""
    rows = table(spark, sf_dir, "events").withColumn("b", F.floor("value") % 24).withColumn("module", F.col("user_id") * 100 + F.col("b"))
    modules = rows.where("event_id % 10 <> 0").select("module", F.col("user_id").alias("person"), (F.col("user_id") % 3).alias("course"), F.concat(F.lit("p"), F.col("b").cast("string")).alias("block")).distinct()
    state = F.when(F.col("event_id") % 5 != 0, F.to_json(F.struct((F.col("event_id") % 4 + 1).alias("attempts")))).otherwise(F.lit("{}"))
    history = rows.select("module", state.alias("state"), ((F.col("event_id") % 3) / 2.0).cast("double").alias("grade"), F.lit(1.0).alias("max_grade"), F.col("ts").alias("at"))
    return facts.module_history(modules, history).withColumn("at", F.date_format("at", "yyyy-MM-dd HH:mm:ss"))


@query("""
    select event_id, user_id, ts::date = max(ts::date) over (partition by user_id) as is_latest from events
""")
def newest_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a course's (here: user's) newest retrieval (here: day) marked."""
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", F.to_date("ts").alias("day"))
    return facts.newest_retrieval(rows, "user_id", "day").select("event_id", "user_id", "is_latest")


@query("""
    with t as (select case when p_partkey % 3 = 0 then upper(p_type) when p_partkey % 3 = 1 then p_type || '!' else p_type end as tag from part),
        n as (select trim(regexp_replace(lower(tag), '[^a-z0-9]+', '_', 'g'), '_') as slug, tag, count(*) as n from t group by all)
    select md5(slug) as tag_key, slug, arg_min(tag, (-n, tag)) as tag, sum(n)::bigint as n from n group by slug
""")
def tag_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags by slug, with a key and their usual spelling."""
    tag = F.when(F.col("p_partkey") % 3 == 0, F.upper("p_type")).when(F.col("p_partkey") % 3 == 1, F.concat("p_type", F.lit("!"))).otherwise(F.col("p_type"))
    return facts.tag_dimension(table(spark, sf_dir, "part").select(tag.alias("tag")), "tag")


@query("""
    select c_custkey, case when c_custkey % 4 = 0 then md5('learn-' || c_custkey) when c_custkey % 4 = 1 then md5('shop-' || c_nationkey) when c_custkey % 4 = 2 then md5('mail-' || c_name) end as user_key from customer
""")
def keys_of_several_id_spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A person's key by the first id that is known."""
    n = F.col("c_custkey")
    spaces = {"learn": F.when(n % 4 == 0, n), "shop": F.when(n % 4 <= 1, F.col("c_nationkey")), "mail": F.when(n % 4 <= 2, F.col("c_name"))}
    return table(spark, sf_dir, "customer").select("c_custkey", identity.key_of_first(spaces).alias("user_key"))


@query("""
    with m as (select unnest(generate_series(timestamp '1996-01-01', timestamp '1998-12-01', interval 3 month)) as until),
        g as (select distinct o_orderpriority as program from orders),
        c as (select program, until, count(o_orderkey) as n_orders, count(distinct o_custkey) as people from g cross join m left join orders on o_orderpriority = program and o_orderdate < until group by all),
        t as (select 'all' as program, until, count(o_orderkey) as n_orders, count(distinct o_custkey) as people from m left join orders on o_orderdate < until group by all)
    select program, strftime(until, '%Y-%m-%d') as until, n_orders, people from (select * from c union all select * from t)
""")
def cumulative_people_with_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and people up to each date, by program (here: priority) and in all: a person counts from their first day on."""
    spine = spark.sql("select explode(sequence(timestamp_ntz'1996-01-01', timestamp_ntz'1998-12-01', interval 3 month)) as until")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", F.col("o_orderpriority").alias("program"))
    both = orders.unionByName(orders.withColumn("program", F.lit("all")))
    first = both.groupBy("program", "o_custkey").agg(F.min("o_orderdate").alias("o_orderdate"), F.count("*").alias("n"))
    counted = both.select("program", "o_orderdate", F.lit(1).alias("orders"), F.lit(0).alias("new")).unionByName(first.select("program", "o_orderdate", F.lit(0).alias("orders"), F.lit(1).alias("new")))
    sums = joins.cumulative(counted, spine, "o_orderdate", "until", ["program"], {"n_orders": F.col("orders").cast("long"), "people": F.col("new").cast("long")})
    return sums.withColumn("until", F.date_format("until", "yyyy-MM-dd"))
