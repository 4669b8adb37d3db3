"""Config queries: settings, replicas, mappings, templates and index metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardlift.functions.mappings import unwrap_mappings
from shardlift.functions.settings import (
    drop_rejected,
    flat_to_tree,
    hoist_leaves,
    round_replicas,
    tree_leaves,
    tree_text,
)
from shardlift.operators import preflight
from shardlift.operators.report import index_summary, template_names
from shardlift.operators.requests import component_links, index_body, missing_components, with_components
from shardlift.operators.transforms import (
    picked_rules,
    rules_for,
    template_rows,
    transform_indices,
    transform_templates,
    with_global_problem,
)
from shardlift.queries.registry import query, table, text
from shardlift.sources.metadata import global_bodies, index_bodies
from shardlift.spread import spread


def fill(pattern: str, *values: Column) -> Column:
    return F.format_string(pattern, *values)


FLAT = (
    '{"index.number_of_shards":"%s","index.number_of_replicas":"%s","index.uuid":"u%s",'
    '"index.version.created":"6082499","index.routing.allocation.brand":"%s","priority":%s}'
)


def spread_parts(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """part rows dealt out over the cores, as each becomes a config body."""
    return spread(table(spark, folder, "part").select("p_partkey", *columns))


def spread_customers(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return spread(table(spark, folder, "customer").select("c_custkey", *columns))


def flat_settings() -> Column:
    size, key = text("p_size"), text("p_partkey")
    return fill(FLAT, size, size, key, F.col("p_brand"), size)


@query(
    """
    SELECT p_partkey,
      '{"index":{"number_of_replicas":"' || p_size || '","number_of_shards":"' || p_size
        || '","routing":{"allocation":{"brand":"' || p_brand || '"}},"uuid":"u' || p_partkey
        || '","version":{"created":"6082499"}},"priority":' || p_size || '}' AS tree,
      '{"number_of_replicas":"' || p_size || '","number_of_shards":"' || p_size
        || '","priority":' || p_size || ',"routing":{"allocation":{"brand":"' || p_brand || '"}}}' AS kept
    FROM part
    """
)
def settings_tree(spark: SparkSession, folder: str) -> DataFrame:
    return (
        spread_parts(spark, folder, "p_brand", "p_size")
        .select("p_partkey", tree_leaves(flat_settings()).alias("t"))
        .select(
            "p_partkey",
            tree_text(F.col("t.leaves")).alias("tree"),
            tree_text(drop_rejected(hoist_leaves(F.col("t.leaves"))["leaves"])).alias("kept"),
        )
    )


# Levels of an object that a dotted key reaches into.
_DEPTHS = (1, 5, 8, 12)


def _levels(depth: int) -> list[str]:
    return [f"a{k}" for k in range(depth)]


def _deep_merged(depth: int) -> str:
    """The tree of `_deep_settings`, as SQL."""
    return "'" + "".join(f'{{"{k}":' for k in _levels(depth)) + '{"b":1,"c":\' || p_size || \'}' + "}" * depth + "'"


@query(
    f"""
    SELECT p_partkey,
      CASE WHEN p_type IN ('SMALL', 'MEDIUM', 'LARGE') THEN NULL ELSE
        CASE p_type WHEN 'PROMO' THEN '{{"a":{{"b":' || p_size || '}}}}'
                    WHEN 'ECONOMY' THEN '{{"a":' || p_size || '}}'
                    ELSE CASE p_partkey % 4 {" ".join(f"WHEN {k} THEN {_deep_merged(d)}" for k, d in enumerate(_DEPTHS))} END
        END END AS tree,
      CASE p_type WHEN 'SMALL' THEN 'settings key passes through a value'
                  WHEN 'MEDIUM' THEN 'settings key has no name'
                  WHEN 'LARGE' THEN 'settings are missing or not an object' END AS problem
    FROM part
    """
)
def settings_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    """Keys that meet: value then child, child then value, trailing dots, an object merged into at some depth."""
    kind, size = F.col("p_type"), text("p_size")

    def deep(depth: int) -> Column:
        names = _levels(depth)
        opened = "".join(f'{{"{k}":' for k in names) + '{"b":1}' + "}" * (depth - 1)
        return fill(f'{opened},"{".".join(names)}.c":%s}}', size)

    merging = F.coalesce(*(F.when(F.col("p_partkey") % 4 == k, deep(d)) for k, d in enumerate(_DEPTHS)))
    flat = (
        F.when(kind == "SMALL", fill('{"a":%s,"a.b":1}', size))
        .when(kind == "MEDIUM", fill('{"..":%s}', size))
        .when(kind == "LARGE", fill("[%s]", size))
        .when(kind == "PROMO", fill('{"a.b..":%s}', size))
        .when(kind == "ECONOMY", fill('{"a.b":1,"a":%s}', size))
        .otherwise(merging)
    )
    return spread_parts(spark, folder, "p_type", "p_size").select("p_partkey", flat_to_tree(flat).alias("t")).select(
        "p_partkey", F.col("t.value").alias("tree"), "t.problem"
    )


@query(
    """
    WITH r AS (
      SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN 0 WHEN 'MEDIUM' THEN 0 WHEN 'LARGE' THEN -1
                                    ELSE p_size END AS r FROM part),
    d AS (SELECT *, unnest([2, 3, 5]) AS dim FROM r)
    SELECT p_partkey, CAST(dim AS INTEGER) AS dimensionality,
           CAST(r + CASE WHEN (r + 1) % dim > 0 THEN dim - (r + 1) % dim ELSE 0 END AS INTEGER) AS replicas
    FROM d
    """
)
def replicas(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers, numeric text, blank text, other text and -1 as replica counts."""
    kind, size = F.col("p_type"), text("p_size")
    value = (
        F.when(kind == "SMALL", F.lit('""'))
        .when(kind == "MEDIUM", F.lit('"auto"'))
        .when(kind == "LARGE", F.lit("-1"))
        .when(kind == "PROMO", fill('" %s "', size))
        .when(kind == "ECONOMY", fill('"%s"', size))
        .otherwise(size)
    )
    rounded = F.array(
        *[
            F.struct(F.lit(d).alias("dimensionality"), round_replicas(value, d).alias("replicas"))
            for d in (2, 3, 5)
        ]
    )
    return spread_parts(spark, folder, "p_type", "p_size").select("p_partkey", F.inline(rounded))


_BODY = """'{"properties":{"n":{"type":"long","x":' || p_size || '}}}'"""


@query(
    f"""
    SELECT p_partkey, CASE p_type WHEN 'STANDARD' THEN '[{{"other":' || {_BODY} || '}}]' WHEN 'PROMO' THEN '[]'
                                  ELSE {_BODY} END AS mappings,
           CASE p_type WHEN 'STANDARD' THEN 'mappings have none of the expected wrappers'
                       WHEN 'PROMO' THEN 'mappings array is empty' END AS problem
    FROM part
    """
)
def mappings(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("p_type")
    body = fill('{"properties":{"n":{"type":"long","x":%s}}}', text("p_size"))
    wrapper = (
        F.when(kind == "SMALL", "_doc").when(kind == "MEDIUM", "doc").when(kind == "LARGE", "audit_message")
    )
    stored = (
        F.when(kind == "ECONOMY", body)
        .when(kind == "PROMO", F.lit("[]"))
        .otherwise(fill('[{"%s":%s}]', F.coalesce(wrapper, F.lit("other")), body))
    )
    return spread_parts(spark, folder, "p_type", "p_size").select("p_partkey", unwrap_mappings(stored).alias("m")).select(
        "p_partkey", F.col("m.value").alias("mappings"), "m.problem"
    )


TEMPLATE = (
    '{"order":%s,"settings":{"index":{"number_of_shards":"1","number_of_replicas":"%s"},"codec":"%s"},'
    '"mappings":[{"_doc":{"properties":{"n":{"type":"long"}}}}]}'
)


def customer_globals(spark: SparkSession, folder: str) -> DataFrame:
    """customer rows as global metadata of one repository each, with all three kinds of templates."""
    nation, name = text("c_nationkey"), F.col("c_mktsegment")
    body = fill(TEMPLATE, nation, nation, name)
    whole = fill(
        '{"templates":{"legacy_%s":%s},"index_template":{"index_template":{"it_%s":{"priority":%s,"template":%s},'
        '"bare_%s":{"composed_of":["ct"]}}},"component_template":{"component_template":{"ct":{"template":%s}}}}',
        name, body, name, nation, body, name, body,
    )
    value = F.concat(F.lit('{"version":7,"meta-data":'), whole, F.lit("}"))
    rows = spread_customers(spark, folder, "c_nationkey", "c_mktsegment")
    return global_bodies(rows.select(text("c_custkey").alias("repo_id"), value.alias("value")))


@query(
    """
    SELECT CAST(c_custkey AS VARCHAR) AS repo_id, 'global_metadata' AS rule, CAST(c_custkey AS VARCHAR) AS subject,
      CASE c_custkey % 6 WHEN 1 THEN 'no readable meta-data' WHEN 2 THEN 'no readable meta-data'
        WHEN 3 THEN 'templates is not an object' ELSE 'index_template.index_template is not an object' END AS detail
    FROM customer WHERE c_custkey % 6 IN (1, 2, 3, 4)
    """
)
def global_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Broken text, no `meta-data`, buckets of a wrong kind; repeated keys are no fault."""
    key, name = F.col("c_custkey"), F.col("c_mktsegment")
    value = (
        F.when(key % 6 == 1, fill('{"meta-data":{"templates":{"%s"', name))
        .when(key % 6 == 2, fill('{"other":{"templates":{"%s":{}}}}', name))
        .when(key % 6 == 3, fill('{"meta-data":{"templates":["%s"]}}', name))
        .when(key % 6 == 4, fill('{"meta-data":{"index_template":{"index_template":"%s"}}}', name))
        .when(key % 6 == 5, fill('{"meta-data":{"templates":{"%s":{"order":1,"order":2}}}}', name))
        .otherwise(fill('{"meta-data":{"templates":{"%s":{}}}}', name))
    )
    rows = spread_customers(spark, folder, "c_mktsegment")
    texts = rows.select(text("c_custkey").alias("repo_id"), value.alias("value"))
    bodies = with_global_problem(global_bodies(texts))
    return preflight.check(bodies, F.col("repo_id"), preflight.problem_rule("global_metadata"))


_C = """
    SELECT CAST(c_custkey AS VARCHAR) AS repo_id, c_mktsegment AS seg, CAST(c_nationkey AS VARCHAR) AS nat,
      CAST(((c_nationkey + 3) // 3) * 3 - 1 AS VARCHAR) AS rep FROM customer
"""
_RAW = """'{"order":' || nat || ',"settings":{"index":{"number_of_shards":"1","number_of_replicas":"' || nat
  || '"},"codec":"' || seg || '"},"mappings":[{"_doc":{"properties":{"n":{"type":"long"}}}}]}'"""


def _hoisted(replicas_: str, mappings_: str) -> str:
    return f"""'{{"order":' || nat || ',"settings":{{"codec":"' || seg
      || '","number_of_shards":"1","number_of_replicas":' || {replicas_} || '}},"mappings":' || '{mappings_}' || '}}'"""


_WRAPPED = '[{"_doc":{"properties":{"n":{"type":"long"}}}}]'
_PLAIN = '{"properties":{"n":{"type":"long"}}}'
_QUOTED = """'"' || nat || '"'"""


@query(
    f"""
    SELECT repo_id, 'template' AS kind, 'legacy_' || seg AS name, {_hoisted("rep", _PLAIN)} AS body FROM ({_C})
    """
)
def templates_6_8(spark: SparkSession, folder: str) -> DataFrame:
    rows = template_rows(customer_globals(spark, folder), rules_for("6.8", "2.11"))
    return transform_templates(rows, "6.8").select("repo_id", "kind", "name", "body")


_T710 = f"""
    WITH c AS ({_C})
    SELECT repo_id, 'template' AS kind, 'legacy_' || seg AS name, %s AS body FROM c
    UNION ALL SELECT repo_id, 'index_template', 'it_' || seg,
      '{{"priority":' || nat || ',"template":' || {_hoisted("rep", _WRAPPED)} || '}}' FROM c
    UNION ALL SELECT repo_id, 'index_template', 'bare_' || seg, '{{"composed_of":["ct"]}}' FROM c
    UNION ALL SELECT repo_id, 'component_template', 'ct', '{{"template":' || {_RAW} || '}}' FROM c
"""


@query(_T710.replace("%s", _hoisted(_QUOTED, _WRAPPED)))
def templates_7_10(spark: SparkSession, folder: str) -> DataFrame:
    rows = template_rows(customer_globals(spark, folder))
    return transform_templates(rows, "7.10").select("repo_id", "kind", "name", "body")


@query(_T710.replace("%s", _hoisted("rep", _WRAPPED)))
def templates_7_10_fixed(spark: SparkSession, folder: str) -> DataFrame:
    """With replicas of legacy templates rounded as well."""
    rows = template_rows(customer_globals(spark, folder))
    done = transform_templates(rows, "7.10", legacy_replica_fix=True)
    return done.select("repo_id", "kind", "name", "body")


@query(
    f"""
    WITH c AS ({_C})
    SELECT repo_id, 'index_template' AS kind, 0 AS ord, 'it_' || seg AS name FROM c
    UNION ALL SELECT repo_id, 'index_template', 1, 'bare_' || seg FROM c
    UNION ALL SELECT repo_id, 'component_template', 0, 'ct' FROM c
    """
)
def report_templates(spark: SparkSession, folder: str) -> DataFrame:
    return template_names(customer_globals(spark, folder), "7.10")


@query(f"SELECT repo_id, 'template' AS kind, 0 AS ord, 'legacy_' || seg AS name FROM ({_C})")
def report_templates_6_8(spark: SparkSession, folder: str) -> DataFrame:
    return template_names(customer_globals(spark, folder), "6.8")


def part_indices(spark: SparkSession, folder: str) -> DataFrame:
    """part rows as index metadata."""
    body = fill(
        '{"version":3,"aliases":{"a%s":{}},"mappings":[{"_doc":{"properties":{"%s":{"type":"long"}}}}],'
        '"settings":%s}',
        text("p_size"), F.col("p_brand"), flat_settings(),
    )
    name = text("p_partkey")
    value = F.concat(fill('{"%s":', name), body, F.lit("}"))
    rows = spread_parts(spark, folder, "p_size", "p_brand")
    return index_bodies(rows.select(name.alias("index_name"), value.alias("value")))


_P = """
    SELECT CAST(p_partkey AS VARCHAR) AS index_name, CAST(p_size AS INTEGER) AS n_shards,
      '{"aliases":{"a' || p_size || '":{}},"mappings":{"properties":{"' || p_brand
      || '":{"type":"long"}}},"settings":{"number_of_replicas":' || ((p_size + 3) // 3) * 3 - 1
      || ',"number_of_shards":"' || p_size || '","priority":' || p_size
      || ',"routing":{"allocation":{"brand":"' || p_brand || '"}}}}' AS body
    FROM part
"""
_P = _P.replace("((p_size + 3) // 3) * 3 - 1", "CAST(((p_size + 3) // 3) * 3 - 1 AS VARCHAR)")


def _index_bodies(spark: SparkSession, folder: str, version: str) -> DataFrame:
    done = transform_indices(part_indices(spark, folder), version)
    body = index_body(F.col("aliases"), F.col("mappings"), F.col("settings"))
    return done.select("index_name", "n_shards", body.alias("body"))


@query(_P)
def index_6_8(spark: SparkSession, folder: str) -> DataFrame:
    return _index_bodies(spark, folder, "6.8")


@query(_P)
def index_7_10(spark: SparkSession, folder: str) -> DataFrame:
    return _index_bodies(spark, folder, "7.10")


@query(
    """
    SELECT CAST(p_partkey AS VARCHAR) AS index_name, CAST(p_size AS INTEGER) AS n_shards,
      '{"index":{"number_of_replicas":"' || p_size || '","number_of_shards":"' || p_size
        || '","routing":{"allocation":{"brand":"' || p_brand || '"}},"uuid":"u' || p_partkey
        || '","version":{"created":"6082499"}},"priority":' || p_size || '}' AS settings,
      '{"properties":{"' || p_brand || '":{"type":"long"}}}' AS mappings,
      '{"a' || p_size || '":{}}' AS aliases
    FROM part
    """
)
def report_index(spark: SparkSession, folder: str) -> DataFrame:
    return index_summary(part_indices(spark, folder)).drop("problem")


@query(
    """
    WITH p AS (
      SELECT l_orderkey, l_linenumber,
             CASE l_returnflag WHEN 'A' THEN '6.8' WHEN 'N' THEN '7.10' ELSE '5.6' END AS source,
             CASE l_linestatus WHEN 'F' THEN '2.11' ELSE CASE WHEN l_linenumber < 4 THEN '2.11' ELSE '1.3' END END AS target
      FROM lineitem),
    r(source, kind, steps) AS (VALUES
      ('6.8', 'template', 'unwrap,hoist,replicas'), ('6.8', 'index', 'unwrap,tree,hoist,replicas'),
      ('7.10', 'template', 'hoist'), ('7.10', 'index_template', 'inner,hoist,replicas'),
      ('7.10', 'component_template', ''), ('7.10', 'index', 'unwrap,tree,hoist,replicas'))
    SELECT l_orderkey, l_linenumber, kind, steps,
           CASE WHEN kind IS NULL THEN 'no transformation from ' || p.source || ' to ' || p.target END AS problem
    FROM p LEFT JOIN r ON r.source = p.source AND p.target = '2.11'
    """
)
def rule_choice(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as pairs of versions, each with the rules of its kinds of objects, or a problem."""
    flag, at = F.col("l_returnflag"), F.col("l_linenumber")
    pairs = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(flag == "A", "6.8").when(flag == "N", "7.10").otherwise("5.6").alias("source"),
        F.when((F.col("l_linestatus") == "F") | (at < 4), "2.11").otherwise("1.3").alias("target"),
    )
    return picked_rules(pairs).select("l_orderkey", "l_linenumber", "kind", F.array_join("steps", ",").alias("steps"), "problem")


@query(
    """
    WITH t AS (SELECT p_partkey, p_size, p_brand, p_partkey % 3 <> 0 AS kept FROM part),
    l AS (SELECT DISTINCT p_partkey, 's' || p_size AS component FROM t WHERE kept
          UNION SELECT p_partkey, p_brand FROM t WHERE kept),
    c AS (SELECT DISTINCT 's' || p_size AS component, p_size % 5 <> 0 AS listed FROM t WHERE p_size % 7 <> 0)
    SELECT p_partkey, l.component,
           CASE WHEN c.component IS NULL THEN 'missing' WHEN c.listed THEN 'listed' ELSE 'added' END AS state
    FROM l LEFT JOIN c USING (component)
    """
)
def template_components(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as index templates composed of their size and brand; some sizes are listed components, some only needed."""
    parts = table(spark, folder, "part").withColumn("repo_id", F.lit("r"))
    size = F.concat(F.lit("s"), text("p_size"))
    body = F.format_string('{"index_patterns":["%s"],"composed_of":["%s","%s"]}', text("p_partkey"), size, F.col("p_brand"))
    none = F.lit("{}").alias("body")
    indices = parts.select("repo_id", F.lit("index_template").alias("kind"), text("p_partkey").alias("name"), body.alias("body"))
    components = parts.where(F.col("p_size") % 7 != 0).select("repo_id", F.lit("component_template").alias("kind"), size.alias("name"), none)
    templates = indices.unionByName(components.distinct())
    number = F.col("name").try_cast("bigint")
    listed = F.regexp_extract("name", "([0-9]+)$", 1).try_cast("bigint") % 5 != 0
    kept = templates.where(F.when(F.col("kind") == "index_template", number % 3 != 0).otherwise(listed))
    closed = with_components(kept, templates)
    have = closed.where("kind = 'component_template'").select(F.col("name").alias("component"))
    listed_ones = kept.where("kind = 'component_template'").select(F.col("name").alias("component"), F.lit("listed").alias("is"))
    lacking = missing_components(closed).select("name", "component", F.lit("missing").alias("state"))
    found = component_links(closed).join(have, "component").join(listed_ones, "component", "left")
    rows = found.select("name", "component", F.coalesce("is", F.lit("added")).alias("state")).unionByName(lacking)
    return rows.select(F.col("name").cast("bigint").alias("p_partkey"), "component", "state")
