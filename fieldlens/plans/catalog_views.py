"""Wide rows, catalog, search, map points and round trips through files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from fieldlens.operators import aggregates as agg
from fieldlens.operators import catalog as cat
from fieldlens.operators import geo, wide
from fieldlens.operators import search_index as si
from fieldlens.operators import sketches
from fieldlens.operators.quality import column_counts
from fieldlens.operators.ranking import first_per_key
from fieldlens.plans.driver import FACT_SQL, fact, materials, table, trials, with_fact
from fieldlens.plans.registry import query
from fieldlens.session import shared_dir, work_path
from fieldlens.sources import sinks, tables
from fieldlens.sources.snapshots import VersionTaken

ABROAD = {"Abroad": ["ASIA", "AFRICA"]}


_TRIAL_CELLS = {"info": ["species", "year"], "geo": ["region", "department", "lat", "lon"],
                "quality": ["fiability_experimental", "fiability_breeder"]}


def _trial_rows(spark, sf_dir, cells=None):
    """Trials as wide rows; with ``cells``, a leading part of them only, and just what these need is read."""
    columns = [c for family in _TRIAL_CELLS.values() for c in family]
    chosen = list(cells or columns)
    assert columns[:len(chosen)] == chosen      # the smallest row of a trial is found by its cells in this order
    of_plots, of_trials = chosen[:2], chosen[2:]
    # The smallest row of a trial is the smallest of its plots next to the trial's own cells, so these join afterwards.
    one = agg.entities(fact(spark, sf_dir, ["QTY"], located=False), "exp_id", of_plots)
    if of_trials:
        one = one.join(agg.entities(trials(spark, sf_dir), "exp_id", of_trials), "exp_id", "left")
    families = {f: [c for c in cs if c in chosen] for f, cs in _TRIAL_CELLS.items()}
    keys = ["year", "exp_id"] if "year" in chosen else ["exp_id"]
    return wide.wide_rows(one, keys, {f: cs for f, cs in families.items() if cs})


_TRIAL_ROWS_SQL = """one AS (
  SELECT * FROM (SELECT exp_id, species, year, region, department, lat, lon, fiability_experimental,
    fiability_breeder, row_number() OVER (PARTITION BY exp_id ORDER BY species NULLS FIRST, year) AS rn
    FROM fact WHERE trait = 'QTY') WHERE rn = 1),
kv_trials AS (SELECT CAST(year AS VARCHAR) || '#' || CAST(exp_id AS VARCHAR) AS row_key, * FROM one)"""


@query("kv_trials", with_fact(f"""
WITH {_TRIAL_ROWS_SQL}
SELECT row_key, species AS info_species, year AS info_year, region AS geo_region,
       department AS geo_department, round(lat, 4) AS geo_lat, round(lon, 4) AS geo_lon,
       fiability_experimental AS quality_experimental, fiability_breeder AS quality_breeder
FROM kv_trials"""))
def kv_trials(spark, sf_dir):
    """Trials as wide rows, cells shown as columns (KV-1)."""
    return _trial_rows(spark, sf_dir).select(
        "row_key", F.col("info.species").alias("info_species"), F.col("info.year").alias("info_year"),
        F.col("geo.region").alias("geo_region"), F.col("geo.department").alias("geo_department"),
        F.round("geo.lat", 4).alias("geo_lat"), F.round("geo.lon", 4).alias("geo_lon"),
        F.col("quality.fiability_experimental").alias("quality_experimental"),
        F.col("quality.fiability_breeder").alias("quality_breeder"))


def _result_rows(spark, sf_dir, traits=("QTY", "PRICE", "DISC", "TAX")):
    rows = fact(spark, sf_dir, list(traits), located=False, material=False).filter(
        "result_num IS NOT NULL")
    return wide.wide_rows(rows, ["stock_id", "exp_id", "design", "rep", "entry", "trait"], {
        "measurement": ["result_num", "trait"], "metadata": ["year", "rep", "entry"]})


_RESULT_KEY = "concat_ws('#', stock_id, exp_id, design, rep, entry, trait)"


@query("kv_results", with_fact(f"""
SELECT {_RESULT_KEY} AS row_key, result_num AS measurement_value, trait AS measurement_trait,
       year AS metadata_year FROM long"""))
def kv_results(spark, sf_dir):
    """Results as wide rows with a six-part key (KV-2)."""
    return _result_rows(spark, sf_dir).select(
        "row_key", F.col("measurement.result_num").alias("measurement_value"),
        F.col("measurement.trait").alias("measurement_trait"),
        F.col("metadata.year").alias("metadata_year"))


@query("kv_results_load", with_fact(f"""
SELECT count(*) AS received, CAST(0 AS BIGINT) AS rejected, count(*) AS inserted,
       count(*) - count(DISTINCT {_RESULT_KEY}) AS collisions FROM long"""))
def kv_results_load(spark, sf_dir):
    """What a load of those rows would report (KV-2, QLT-15)."""
    from fieldlens.operators.quality import row_key_report
    return row_key_report(_result_rows(spark, sf_dir), "row_key")


@query("kv_materials", """
SELECT CAST(p_partkey AS VARCHAR) AS row_key, p_name AS identity_main_name, p_brand AS identity_pedigree,
       p_type AS taxonomy_species FROM part""")
def kv_materials(spark, sf_dir):
    """Materials as wide rows, last write per key (KV-3)."""
    one = first_per_key(materials(spark, sf_dir), ["stock_id"],
                        ["main_name", "pedigree", "species", "species_code", "species_label"])
    rows = wide.wide_rows(one, ["stock_id"], {
        "identity": ["main_name", "pedigree"], "taxonomy": ["species", "species_label"]})
    return rows.select(
        "row_key", F.col("identity.main_name").alias("identity_main_name"),
        F.col("identity.pedigree").alias("identity_pedigree"),
        F.col("taxonomy.species").alias("taxonomy_species"))


@query("kv_scan_filter", with_fact(f"""
WITH {_TRIAL_ROWS_SQL}
SELECT row_key, species, year, region, round(lat, 4) AS lat, round(lon, 4) AS lon
FROM kv_trials WHERE region = 'ASIA'"""))
def kv_scan_filter(spark, sf_dir):
    """Wide rows whose region cell has a value (KV-4)."""
    out = wide.scan(_trial_rows(spark, sf_dir), F.col("geo.region") == "ASIA", {
        "species": "info.species", "year": "info.year", "region": "geo.region",
        "lat": "geo.lat", "lon": "geo.lon"})
    return out.withColumns({"lat": F.round("lat", 4), "lon": F.round("lon", 4)})


@query("kv_join_scan", with_fact(f"""
WITH {_TRIAL_ROWS_SQL},
cells AS (SELECT exp_id, trait, result_num AS v FROM long WHERE trait IN ('PRICE', 'QTY') AND result_num IS NOT NULL)
SELECT t.species, c.trait, count(c.v) AS measures, round(sum(c.v) / count(c.v), 2) AS mean, round(min(c.v), 2) AS lowest,
       round(max(c.v), 2) AS highest
FROM kv_trials t, cells c WHERE split_part(t.row_key, '#', 2) = CAST(c.exp_id AS VARCHAR) GROUP BY ALL"""))
def kv_join_scan(spark, sf_dir):
    """Wide results joined to wide trials on the id that both keys hold (KV-5, JN-9).

    Results are folded per trial and trait first; the ids are compared as they are, not as text.
    """
    cells = _result_rows(spark, sf_dir, ["QTY", "PRICE"]).select(
        F.col("ids.exp_id").alias("exp_id"), F.col("measurement.trait").alias("trait"), F.col("measurement.result_num").alias("v"))
    folded = cells.groupBy("exp_id", "trait").agg(
        F.count("v").alias("n"), F.sum("v").alias("s"), F.min("v").alias("low"), F.max("v").alias("high"))
    species = _trial_rows(spark, sf_dir, ["species"]).select(F.col("ids.exp_id").alias("exp_id"), F.col("info.species").alias("species"))
    return folded.join(species, "exp_id").groupBy("species", "trait").agg(
        F.sum("n").alias("measures"), F.round(F.sum("s") / F.sum("n"), 2).alias("mean"),
        F.round(F.min("low"), 2).alias("lowest"), F.round(F.max("high"), 2).alias("highest"))


DATASETS = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
            "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
WIDTHS = dict(region=2, nation=3, customer=5, supplier=4, part=6, orders=6, lineitem=11, events=6,
              documents=5, embeddings=3, pages=3, benchmark=2, labels=3, conversations=4)


@query("catalog_datasets", " UNION ALL ".join(
    f"SELECT '{d}' AS name, 'raw' AS layer, 'parquet' AS format, count(*) AS n_rows, "
    f"{WIDTHS[d]} AS n_columns FROM {d}" for d in DATASETS))
def catalog_datasets(spark, sf_dir):
    """Every given table with its rows and columns (CAT-1)."""
    return cat.dataset_catalog({d: table(spark, sf_dir, d) for d in DATASETS},
                               {d: {"layer": "raw", "format": "parquet"} for d in DATASETS})


_COLUMNS = {
    "orders": {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
               "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"},
    "part": {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string",
             "p_size": "int", "p_retailprice": "double"},
    "lineitem": {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint",
                 "l_linenumber": "int", "l_quantity": "double", "l_extendedprice": "double",
                 "l_discount": "double", "l_tax": "double", "l_returnflag": "string",
                 "l_linestatus": "string", "l_shipdate": "timestamp_ntz"},
    "documents": {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string",
                  "n_chars": "bigint"},
    "region": {"r_regionkey": "int", "r_name": "string"},
    "nation": {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"},
    "customer": {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double",
                 "c_mktsegment": "string"},
    "supplier": {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"},
    "events": {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string",
               "value": "double", "props": "string"},
    "embeddings": {"vec_id": "bigint", "embedding": "array<float>", "label": "int"},
    "pages": {"page_id": "bigint", "url": "string", "html": "string"},
    "benchmark": {"item_id": "bigint", "text": "string"},
    "labels": {"doc_id": "bigint", "quality": "int", "toxic": "int"},
    "conversations": {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"},
}


@query("catalog_columns", " UNION ALL ".join(
    f"SELECT '{d}' AS dataset, '{c}' AS column_name, '{t}' AS data_type, count(*) > count({c}) AS nullable, "
    f"round((count(*) - count({c})) / count(*), 6) AS null_rate, "
    f"count(DISTINCT {c}) AS distinct_count FROM {d}" for d, cs in _COLUMNS.items() for c, t in cs.items()))
def catalog_columns(spark, sf_dir):
    """Type, null rate and distinct values of every column of every table (CAT-2)."""
    return cat.column_catalog({d: table(spark, sf_dir, d) for d in _COLUMNS})


_SKETCHED = [d for d in _COLUMNS if d not in ("documents", "pages")]


@query("sketch_columns", " UNION ALL ".join(
    f"SELECT '{d}' AS dataset, '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS nulls, "
    f"count(DISTINCT {c}) AS distinct_count, true AS within_error FROM {d}" for d in _SKETCHED for c in _COLUMNS[d]))
def sketch_columns(spark, sf_dir):
    """Distinct values by sketches of files, merged per table, next to the exact count (AGG-16, CAT-2, QLT-1)."""
    given = {d: table(spark, sf_dir, d) for d in _SKETCHED}
    told = reduce(lambda a, b: a.unionByName(b), [
        sketches.merged(sketches.file_sketches(df), ["column_name"]).withColumn("dataset", F.lit(d)) for d, df in given.items()])
    exact = column_counts(given).select("dataset", "column_name", F.col("uniques").alias("distinct_count"))
    return sketches.with_estimate(told).join(exact, ["dataset", "column_name"]).select(
        "dataset", "column_name", "n_rows", "nulls", "distinct_count",
        sketches.within_error(F.col("distinct_estimate"), F.col("distinct_count")).alias("within_error"))


_FOOTERS = {"orders": "o_orderkey", "lineitem": "l_quantity", "part": "p_retailprice", "customer": "c_acctbal", "events": "event_id",
            "documents": "n_chars", "embeddings": "vec_id", "conversations": "conv_id"}


@query("file_summary", " UNION ALL ".join(
    f"SELECT '{d}' AS dataset, count(*) AS n_rows, CAST(min({c}) AS DOUBLE) AS lowest, CAST(max({c}) AS DOUBLE) AS highest FROM {d}"
    for d, c in _FOOTERS.items()))
def file_summary(spark, sf_dir):
    """Rows and range of a column per table, from the footers of its files (SRC-9)."""
    rows = []
    for d, c in _FOOTERS.items():
        n, *ends = tables.footer_summary(spark, f"{sf_dir}/{d}.parquet", c).first()
        rows.append((d, n, *[None if x is None else float(x) for x in ends]))
    return spark.createDataFrame(rows, "dataset string, n_rows long, lowest double, highest double")


@query("file_rows", " UNION ALL ".join(
    f"SELECT '{d}' AS dataset, 1::BIGINT AS n_files, count(*) AS n_rows FROM {d}" for d in ("orders", "lineitem", "part")))
def file_rows(spark, sf_dir):
    """Files and rows per table, counted per file (SRC-9)."""
    parts = [tables.file_rows(table(spark, sf_dir, d)).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("n_rows").alias("n_rows")).select(F.lit(d).alias("dataset"), "*")
        for d in ("orders", "lineitem", "part")]
    return reduce(lambda a, b: a.unionByName(b), parts)


_TOKENS = "list_filter(string_split_regex(translate(lower(coalesce({t}, '')), '%s', '%s'), '%s'), lambda x: x <> '')" % (
    cat.ACCENTED, cat.FOLDED, cat.NOT_TOKEN)
_DOCUMENTS_SQL = "SELECT 'document' AS entity_type, CAST(doc_id AS VARCHAR) AS entity_id, lang AS title, text AS description FROM documents"
_DATASETS_SQL = f"SELECT 'dataset', name, name, 'raw parquet' FROM (SELECT unnest({list(DATASETS)!r}) AS name)"
_ENTITIES_SQL = f"""ents AS ({_DOCUMENTS_SQL}
  UNION ALL SELECT 'material', CAST(p_partkey AS VARCHAR), p_name, p_type || ' ' || p_brand FROM part
  UNION ALL {_DATASETS_SQL})"""
_ADDED_SQL = f"""ents AS ({_DOCUMENTS_SQL}
  UNION ALL SELECT 'material', CAST(p_partkey AS VARCHAR), p_name, p_brand FROM part
  UNION ALL {_DATASETS_SQL}
  UNION ALL SELECT 'benchmark', CAST(item_id AS VARCHAR), 'item', text FROM benchmark)"""
_INDEX_SQL = f"""idx AS (SELECT token, entity_type, entity_id, count(*) AS tf FROM (
  SELECT entity_type, entity_id, unnest({_TOKENS.replace("{t}", "concat_ws(' ', entity_type, title, description)")}) AS token FROM ents)
  GROUP BY token, entity_type, entity_id)"""
# The columns of an entity as one list of tokens with gaps between them, for phrases.
_PLACED_SQL = f"""placed AS (SELECT entity_type, entity_id, list_concat(list_append({_TOKENS.replace("{t}", "entity_type")}, ''),
  list_concat(list_append({_TOKENS.replace("{t}", "title")}, ''), {_TOKENS.replace("{t}", "description")})) AS l FROM ents)"""


def _materials(spark, sf_dir, description=("species", "pedigree")):
    return cat.entity_rows(materials(spark, sf_dir), "material", "stock_id", "main_name", list(description))


def _entities(spark, sf_dir):
    """Documents, materials and datasets."""
    documents = cat.entity_rows(table(spark, sf_dir, "documents"), "document", "doc_id", "lang", ["text"])
    datasets = spark.createDataFrame([("dataset", d, d, "raw parquet") for d in DATASETS], si.ENTITIES)
    return documents.unionByName(_materials(spark, sf_dir)).unionByName(datasets)


def _added(spark, sf_dir):
    """A later batch: benchmark items are new, materials lose their species."""
    items = cat.entity_rows(table(spark, sf_dir, "benchmark").withColumn("title", F.lit("item")), "benchmark", "item_id", "title", ["text"])
    return items.unionByName(_materials(spark, sf_dir, ["pedigree"]))


def kept_index(spark, sf_dir, version):
    """The index of these tables: version 1 has all entities, version 2 the later batch too.

    It lies in the shared folder under a mark of the tables it was built from. What is there is opened;
    only a version that nobody has built yet is built.
    """
    marks = tables.mark(spark, [f"{sf_dir}/{t}.parquet" for t in ("documents", "part", "benchmark")])
    root = f"{shared_dir(spark)}/search-{si.FORMAT}-{marks}"
    have = si.open_index(spark, root)
    for number, batch in enumerate((_entities, _added), 1):
        if number > version or (have and have.version.number >= number):
            continue
        try:
            have = si.add(batch(spark, sf_dir), root, have)
        except VersionTaken:
            have = si.open_index(spark, root)
    return si.open_index(spark, root, version)


_STORED = ["orders", "part", "customer"]


@query("catalog_tables", f"""
WITH ents AS (SELECT 'material' AS entity_type, CAST(p_partkey AS VARCHAR) AS entity_id, p_name AS title, p_type || ' ' || p_brand AS description FROM part),
{_INDEX_SQL}
SELECT 'datasets' AS stored, count(*) AS n_rows, CAST(sum(n) AS BIGINT) AS total FROM ({" UNION ALL ".join(f"SELECT count(*) AS n FROM {d}" for d in _STORED)})
UNION ALL SELECT 'columns', count(*), CAST(sum(n) AS BIGINT) FROM ({" UNION ALL ".join(f"SELECT count(DISTINCT {c}) AS n FROM {d}" for d in _STORED for c in _COLUMNS[d])})
UNION ALL SELECT 'lineage', 2, NULL
UNION ALL SELECT 'search_index', count(*), CAST(sum(tf) AS BIGINT) FROM idx""")
def catalog_tables(spark, sf_dir):
    """The four catalog tables written in one run and read back: rows and a total of each (SNK-9)."""
    folder = work_path(spark, "catalog")
    given = {d: table(spark, sf_dir, d) for d in _STORED}
    cat.write_catalog(spark, folder, cat.dataset_catalog(given, {}), cat.column_catalog(given),
                      cat.lineage(spark, [("orders", "fact", "join"), ("part", "fact", "join")]), cat.token_index(_materials(spark, sf_dir)))
    totals = {"datasets": F.sum("n_rows"), "columns": F.sum("distinct_count"), "lineage": F.lit(None), "search_index": F.sum("tf")}
    return reduce(lambda a, b: a.unionByName(b), [
        spark.read.parquet(f"{folder}/{name}").agg(F.count(F.lit(1)).alias("n_rows"), total.cast("long").alias("total")).select(
            F.lit(name).alias("stored"), "*") for name, total in totals.items()])


@query("search_index", f"WITH {_ENTITIES_SQL}, {_INDEX_SQL} SELECT token, entity_type, entity_id, tf FROM idx")
def search_index(spark, sf_dir):
    """Inverted index of documents, materials and datasets, whole texts, kept sorted by token (CAT-4)."""
    return kept_index(spark, sf_dir, 1).postings().select("token", "entity_type", "entity_id", "tf")


def _page_sql(hits: str, columns: str = "") -> str:
    return f"""SELECT {columns}h.entity_type, h.entity_id, e.title, e.description, score
FROM (SELECT * FROM ({hits}) ORDER BY score DESC, entity_type, entity_id LIMIT 25) h
JOIN ents e ON h.entity_type = e.entity_type AND h.entity_id = e.entity_id"""


_THE_AND_WITH = """SELECT entity_type, entity_id, CAST(sum(tf) AS BIGINT) AS score FROM idx
WHERE token IN ('the', 'and', 'with') GROUP BY entity_type, entity_id HAVING count(DISTINCT token) = 3"""


@query("search_query", f"WITH {_ENTITIES_SQL}, {_INDEX_SQL} {_page_sql(_THE_AND_WITH)}")
def search_query(spark, sf_dir):
    """Documents that hold all three words, from the kept index (CAT-5)."""
    return kept_index(spark, sf_dir, 1).search("The and WITH")


_LES_ERE = """SELECT entity_type, entity_id, CAST(sum(tf) AS BIGINT) AS score FROM idx
WHERE token = 'les' OR starts_with(token, 'ere') GROUP BY entity_type, entity_id
HAVING count(CASE WHEN token = 'les' THEN 1 END) > 0 AND count(CASE WHEN starts_with(token, 'ere') THEN 1 END) > 0"""


@query("search_prefix", f"WITH {_ENTITIES_SQL}, {_INDEX_SQL} {_page_sql(_LES_ERE)}")
def search_prefix(spark, sf_dir):
    """A word and the start of another, accents ignored (CAT-5)."""
    return kept_index(spark, sf_dir, 1).search("lés éré*")


_RED_PROMO = """SELECT entity_type, entity_id, CAST(sum(tf) AS BIGINT) AS score FROM idx
WHERE token IN ('red', 'promo', 'material') GROUP BY entity_type, entity_id HAVING count(DISTINCT token) = 3"""


@query("search_materials", f"WITH {_ENTITIES_SQL}, {_INDEX_SQL} {_page_sql(_RED_PROMO)}")
def search_materials(spark, sf_dir):
    """Materials by words of type, name, species and pedigree (CAT-5)."""
    return kept_index(spark, sf_dir, 1).search("material red promo")


_OF_THE = """SELECT entity_type, entity_id, CAST(n + with_ AS BIGINT) AS score FROM (
  SELECT entity_type, entity_id, len(list_filter(range(1, len(l)), lambda i: l[i] = 'of' AND l[i + 1] = 'the')) AS n,
         len(list_filter(l, lambda x: x = 'with')) AS with_ FROM placed) WHERE n > 0 AND with_ > 0"""


@query("search_phrase", f"WITH {_ENTITIES_SQL}, {_PLACED_SQL} {_page_sql(_OF_THE)}")
def search_phrase(spark, sf_dir):
    """A quoted phrase, matched by the places of its words, and a word (CAT-5)."""
    return kept_index(spark, sf_dir, 1).search('"of the" with')


_AFTER = """SELECT entity_type, entity_id, CAST(sum(tf) AS BIGINT) AS score FROM idx
WHERE token IN ('{a}', '{b}') GROUP BY entity_type, entity_id HAVING count(DISTINCT token) = 2"""


@query("search_added", f"WITH {_ADDED_SQL}, {_INDEX_SQL} " + " UNION ALL ".join(
    f"SELECT * FROM ({_page_sql(_AFTER.format(a=a, b=b), f"'{a} {b}' AS asked, ")})"
    for a, b in (("benchmark", "the"), ("material", "promo"), ("material", "red"))))
def search_added(spark, sf_dir):
    """The index after a batch that adds entities and replaces others: three searches (CAT-4, CAT-5)."""
    index = kept_index(spark, sf_dir, 2)
    asked = ("benchmark the", "material promo", "material red")
    return reduce(lambda a, b: a.unionByName(b), [
        index.search(q).select(F.lit(q).alias("asked"), "*") for q in asked])


_POINTS_SQL = """points AS (
  SELECT exp_id, min(species) AS species, year, department, region, lat, lon, n_measures, traits,
         CASE WHEN region IN ('ASIA', 'AFRICA') THEN 'Abroad' ELSE 'Home' END AS country
  FROM (SELECT *, row_number() OVER (PARTITION BY exp_id ORDER BY species NULLS FIRST, year) AS rn FROM fact
        WHERE lat BETWEEN 40 AND 55 AND lon BETWEEN -5 AND 12)
  JOIN (SELECT exp_id, count(*) AS n_measures, list_sort(list(DISTINCT trait)) AS traits
        FROM fact GROUP BY exp_id) USING (exp_id)
  WHERE rn = 1 GROUP BY ALL)"""


def _points(spark, sf_dir):
    return geo.map_points(fact(spark, sf_dir), "exp_id",
                          ["species", "year", "department", "region", "lat", "lon"],
                          abroad=ABROAD, home="Home")


@query("geo_points", with_fact(f"""
WITH {_POINTS_SQL}
SELECT exp_id, species, year, department, region, round(lat, 6) AS lat, round(lon, 6) AS lon,
       n_measures, array_to_string(traits, ',') AS traits, country FROM points"""))
def geo_points(spark, sf_dir):
    """Located trials inside the map box (GEO-1, AGG-21, JN-13)."""
    return _points(spark, sf_dir).withColumns({
        "lat": F.round("lat", 6), "lon": F.round("lon", 6),
        "traits": F.array_join("traits", ",")})


@query("geo_facets", with_fact(f"""
WITH {_POINTS_SQL}
SELECT DISTINCT facet, value FROM (
  SELECT 'species' AS facet, species AS value FROM points UNION ALL
  SELECT 'year', CAST(year AS VARCHAR) FROM points UNION ALL
  SELECT 'region', region FROM points UNION ALL SELECT 'traits', unnest(traits) FROM points)
WHERE value IS NOT NULL"""))
def geo_facets(spark, sf_dir):
    """Values offered by each facet (GEO-2, FN-6)."""
    return geo.facet_values(_points(spark, sf_dir), ["species", "year", "region"], ["traits"])


@query("facet_filter", with_fact(f"""
WITH {_POINTS_SQL}
SELECT exp_id, species, year, region, country FROM points
WHERE species = 'PROMO' AND country = 'Abroad' AND list_contains(traits, 'TAX')"""))
def facet_filter(spark, sf_dir):
    """Points under three chosen facets (GEO-3, FLT-12)."""
    chosen = geo.select_facets(_points(spark, sf_dir), {"species": "PROMO", "country": "Abroad"},
                               {"traits": "TAX"})
    return chosen.select("exp_id", "species", "year", "region", "country")


@query("json_fields", """
SELECT event_type, count(*) AS n_rows, CAST(sum(CAST(props->>'$.k' AS BIGINT)) AS BIGINT) AS sum_k
FROM events GROUP BY event_type""")
def json_fields(spark, sf_dir):
    """A field of a JSON column (FN-8)."""
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(k).alias("sum_k"))


@query("delimited_roundtrip", """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size,
       CAST(p_retailprice AS VARCHAR) AS p_retailprice FROM part""")
def delimited_roundtrip(spark, sf_dir):
    """Written as ;-separated text with a byte-order mark and read back (SRC-1, SRC-6, SNK-2)."""
    path = work_path(spark, "delimited")
    sinks.write_delimited(table(spark, sf_dir, "part"), path, bom=True)
    return tables.read_delimited(spark, path)


_IMPORTED = ("part", "customer", "supplier", "orders", "nation", "region")


@query("ingest_report", " UNION ALL ".join(
    f"SELECT '{d}' AS name, count(*) AS n_rows, {WIDTHS[d]} AS n_columns, 'SUCCEEDED' AS status FROM {d}" for d in _IMPORTED))
def ingest_report(spark, sf_dir):
    """Six import jobs from delimited text to Parquet, one report row each (SRC-2)."""
    sources = {}
    for name in _IMPORTED:
        sources[name] = work_path(spark, f"csv-{name}")
        sinks.write_delimited(table(spark, sf_dir, name), sources[name])
    report = sinks.ingest(spark, sources, work_path(spark, "raw"))
    return report.select("name", "n_rows", "n_columns", "status")


@query("partitioned_layer", f"""
WITH {FACT_SQL}
SELECT species, trait, count(*) AS n_rows, round(avg(result_num), 3) AS mean FROM fact
WHERE year = 1998 AND species IN ('PROMO', 'SMALL') GROUP BY species, trait""")
def partitioned_layer(spark, sf_dir):
    """Fact table written by year and species; the query reads two partitions (SNK-1, SNK-6)."""
    path = work_path(spark, "fact")
    sinks.save_table(fact(spark, sf_dir, located=False), path, ["year", "species"])
    stored = spark.read.parquet(path)
    chosen = stored.filter((F.col("year") == 1998) & F.col("species").isin("PROMO", "SMALL"))
    return chosen.groupBy("species", "trait").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.avg("result_num"), 3).alias("mean"))


@query("json_roundtrip", """
SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""")
def json_roundtrip(spark, sf_dir):
    """Appended as JSON lines and read back with a schema (SRC-7, SNK-5)."""
    path = work_path(spark, "lines")
    rows = table(spark, sf_dir, "supplier")
    sinks.append_json_lines(rows.filter("s_suppkey % 2 = 0"), path)
    sinks.append_json_lines(rows.filter("s_suppkey % 2 <> 0"), path)
    return spark.read.schema(rows.schema).json(path)
