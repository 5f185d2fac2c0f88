"""Metadata catalog and token search over datasets, materials and documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.operators.quality import column_counts
from fieldlens.operators.ranking import first_per_key
from fieldlens.session import discard, stored

# --- fixed values: letters folded before tokens are compared ------------------
ACCENTED = "àâäáãåçéèêëíìîïñóòôöõúùûüýÿ"
FOLDED = "aaaaaaceeeeiiiinooooouuuuyy"
NOT_TOKEN = r"[^\p{L}\p{N}]+"
# ------------------------------------------------------------------------------


def dataset_catalog(datasets: Mapping[str, DataFrame], facts: Mapping[str, Mapping[str, str]],
                    ) -> DataFrame:
    """One row per dataset: given facts, rows and columns (CAT-1)."""
    parts = []
    for name, df in datasets.items():
        given = [F.lit(v).alias(k) for k, v in facts.get(name, {}).items()]
        parts.append(df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("name"), *given, "n_rows", F.lit(len(df.columns)).alias("n_columns")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def column_catalog(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """Type, nullability, null rate and distinct values of every column (CAT-2)."""
    return column_counts(datasets).select(
        "dataset", "column_name", F.col("dtype").alias("data_type"), (F.col("nulls") > 0).alias("nullable"),
        F.round(F.try_divide("nulls", "n_rows"), 6).alias("null_rate"), F.col("uniques").alias("distinct_count"))


def lineage(spark: SparkSession, edges: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Source, target and transformation of each edge (CAT-3)."""
    return spark.createDataFrame(list(edges), "source string, target string, transformation string")


def tokens(text: Column) -> Column:
    """Lower-case tokens with folded accents."""
    folded = F.translate(F.lower(text), ACCENTED, FOLDED)
    return F.filter(F.split(folded, NOT_TOKEN), lambda t: t != "")


def entity_rows(df: DataFrame, entity_type: str, key: str, title: str,
                description: Sequence[str]) -> DataFrame:
    """Searchable entities, one per key (CAT-4)."""
    rows = df.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("string").alias("entity_id"), F.col(title).alias("title"),
        F.concat_ws(" ", *description).alias("description"))
    one = first_per_key(rows, ["entity_id"], ["title", "description"])
    return one.select(F.lit(entity_type).alias("entity_type"), *one.columns)


def token_index(entities: DataFrame, columns: Sequence[str] = ("entity_type", "title", "description")) -> DataFrame:
    """Inverted index: token, entity, its frequency and its places, over whole texts (CAT-4).

    ``entities`` has one row per entity, as from ``entity_rows``. The type of an entity is searchable like its title.

    Places count the tokens of all columns, with a gap between two columns, so that no phrase crosses them. The tokens
    of an entity are sorted inside its row, where equal ones stand together, so no word is shuffled before the index
    itself is dealt out.
    """
    apart = F.array(F.lit(""))
    lists = [F.coalesce(tokens(F.col(c)), F.array().cast("array<string>")) for c in columns]
    row = F.concat(*[x for c in lists for x in (c, apart)])
    placed = F.filter(F.transform(row, lambda t, i: F.struct(t.alias("token"), i.alias("place"))), lambda w: w["token"] != "")
    found = F.transform(F.array(F.sort_array(placed)), _postings)[0]      # an array of one: the sorted words have a name then
    return entities.select(F.inline(found), "entity_type", "entity_id").select("token", "entity_type", "entity_id", "tf", "places")


def _postings(words: Column) -> Column:
    """token, tf and places of each distinct token among words (token, place) in their order."""
    n = F.size(words)
    numbers = F.filter(F.sequence(F.lit(0), n), lambda i: i < n)
    starts = F.filter(numbers, lambda i: (i == 0) | (F.get(words, i)["token"] != F.get(words, i - 1)["token"]))

    def posting(first: Column, start: Column, k: Column) -> Column:
        tf = F.coalesce(F.get(first, k + 1), n) - start
        return F.struct(F.get(words, start)["token"].alias("token"), tf.cast("long").alias("tf"),
                        F.transform(F.slice(words, start + 1, tf), lambda w: w["place"]).alias("places"))
    return F.transform(F.array(starts), lambda first: F.transform(first, lambda start, k: posting(first, start, k)))[0]


def write_index(index: DataFrame, path: str) -> DataFrame:
    """Store the index sorted by token and read it back (SNK-9).

    Range partitions and sorted files give every file and row group a narrow span of tokens, so a
    filter on a token, or on the start of one, skips the others by their statistics. A frequent token
    spreads over several ranges, because the entity is part of the order. The rows are stored before they are
    dealt out, since the cuts of the ranges take a pass of their own.
    """
    order = ["token", "entity_type", "entity_id"]
    rows, _ = stored(index, "postings")
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)
    discard(rows)
    return index.sparkSession.read.schema(index.schema).parquet(path)


def _fold(word: str) -> str:
    return word.lower().translate(str.maketrans(ACCENTED, FOLDED))


def _words(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in _fold(text)).split()


@dataclass(frozen=True, order=True)
class Term:
    """A word, the start of one, or the words of a phrase."""

    tokens: tuple[str, ...]
    prefix: bool = False

    def matches(self) -> Column:
        token = F.col("token")
        return token.startswith(self.tokens[0]) if self.prefix else token.isin(*self.tokens)


def parse_query(query: str) -> list[Term]:
    """Terms of a query: words, words with a trailing star, quoted phrases. All of them must match.

    A word with signs inside counts as several words. Empty or unbalanced queries are errors.
    """
    parts = query.split('"')
    if len(parts) % 2 == 0:
        raise ValueError("unbalanced quote in the query")
    terms = set()
    for k, part in enumerate(parts):
        if k % 2:
            phrase = tuple(_words(part))
            if phrase:
                terms.add(Term(phrase))
            continue
        for word in part.split():
            cleaned = _words(word.rstrip("*"))
            terms |= {Term((token,), word.endswith("*") and i == len(cleaned) - 1) for i, token in enumerate(cleaned)}
    if not terms:
        raise ValueError("the query has no words")
    return sorted(terms)


def _phrase_hits(term: Term) -> Column:
    """How often the phrase stands in an entity: places of its first word at which all words follow in order."""
    def begins(token: str, before: int) -> Column:
        places = F.coalesce(F.max(F.when(F.col("token") == token, F.col("places"))), F.array().cast("array<int>"))
        return F.transform(places, lambda p: p - before)

    shifted = [begins(t, i) for i, t in enumerate(term.tokens)]
    return F.size(reduce(F.array_intersect, shifted))


def matching(index: DataFrame, terms: Sequence[Term], by: Sequence[str] = ("entity_type", "entity_id")) -> DataFrame:
    """Every entity that satisfies all terms, with its score; the order of the page is the caller's.

    Only rows with the terms' tokens leave the index. The score is the frequency of the words plus the number of
    times that the phrases stand.
    """
    words = [t for t in terms if len(t.tokens) == 1]
    phrases = [t for t in terms if len(t.tokens) > 1]
    any_of = lambda ts: reduce(lambda a, b: a | b, [t.matches() for t in ts], F.lit(False))
    measures = [F.coalesce(F.sum(F.when(any_of(words), F.col("tf"))), F.lit(0)).alias("score")]
    measures += [F.max(t.matches().cast("int")).alias(f"m{i}") for i, t in enumerate(words)]
    measures += [_phrase_hits(t).alias(f"p{i}") for i, t in enumerate(phrases)]
    found = index.filter(any_of(terms)).groupBy(*by).agg(*measures)
    for name in [f"m{i}" for i in range(len(words))] + [f"p{i}" for i in range(len(phrases))]:
        found = found.filter(F.col(name) > 0)
    score = reduce(lambda a, b: a + b, [F.col(f"p{i}") for i in range(len(phrases))], F.col("score"))
    return found.select(*by, score.cast("long").alias("score"))


def page(found: DataFrame, limit: int) -> DataFrame:
    """Best match first: score, then type and id."""
    return found.orderBy(F.col("score").desc(), "entity_type", "entity_id").limit(limit)


def search(index: DataFrame, query: str, limit: int = 25) -> DataFrame:
    """Entities that satisfy every term of the query, best match first (CAT-5)."""
    return page(matching(index, parse_query(query)), limit)


def with_titles(hits: DataFrame, entities: DataFrame) -> DataFrame:
    """Add title and description to a page of hits.

    The page is limited, so its ids go into the scan of ``entities`` as a filter, which a store sorted by id
    answers from few row groups.
    """
    rows = hits.collect()
    known = entities.filter(F.col("entity_id").isin(*[r["entity_id"] for r in rows])) if rows else entities.limit(0)
    return known.join(F.broadcast(hits.sparkSession.createDataFrame(rows, hits.schema)), ["entity_type", "entity_id"])


def write_catalog(spark: SparkSession, folder: str, datasets: DataFrame, columns: DataFrame,
                  edges: DataFrame, index: DataFrame) -> None:
    """The four catalog tables (SNK-9)."""
    datasets.write.mode("overwrite").parquet(f"{folder}/datasets")
    columns.write.mode("overwrite").parquet(f"{folder}/columns")
    edges.write.mode("overwrite").parquet(f"{folder}/lineage")
    write_index(index, f"{folder}/search_index")
