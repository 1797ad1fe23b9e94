"""Unified feed, entity resolution and entity analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedweave.functions import scalars as S
from feedweave.functions.text import paren_symbol, slug, url_slug
from feedweave.operators import entities as E
from feedweave.operators import resolve as R
from feedweave.operators.normalize import public, to_records, unify
from feedweave.plans import sql
from feedweave.plans import tables as t
from feedweave.plans.catalog import query

# A dictionary of things that occur in the tables.
GOODS = R.AliasBook.of([("bolt", "steel-bolt"), ("anvil", "iron-anvil"), ("widget", "widget")])

LANGUAGE_CASCADE = (
    R.url_entity(t.PATH_LANGUAGE),
    lambda clues, book: F.when(clues.source_type == "text", clues.identity["symbol"]),
)
GOODS_CASCADE = (
    R.symbol_of_id, R.alias_of_field, R.alias_of_title, R.alias_in_parens, R.alias_in_title,
    R.url_entity(t.PATH_LANGUAGE), R.slug_of_title,
)
_GOODS = sql.values("aliases", GOODS.aliases)


def _texts(spark, folder):
    """Documents and pages with their language as the entity."""
    feeds = unify([t.documents(spark, folder), t.pages(spark, folder)])
    return R.resolve(feeds, R.AliasBook(), LANGUAGE_CASCADE)


_TEXTS = f"""{sql.FEEDS},
texts AS (SELECT *, category AS canonical_id FROM text_feed
          UNION ALL BY NAME SELECT *, category AS canonical_id FROM rss_feed)"""


def _goods(spark, folder):
    """Parts named by the goods dictionary only; what it does not know stays unresolved."""
    return R.resolve(t.parts(spark, folder), GOODS, (R.alias_of_title, R.alias_in_title))


_PARTS = f"""{_GOODS}, {sql.FEEDS},
goods AS (SELECT *, {sql.containment(sql.key_of('title'))} AS canonical_id FROM api2_feed)"""


@query(f"""WITH {sql.FEEDS}
SELECT source_type, source_id, title, md5(description) AS description_md5, value, category, tags,
       {sql.stamp('source_timestamp')} AS source_timestamp, origin
FROM (SELECT * FROM csv_feed UNION ALL SELECT * FROM api1_feed
      UNION ALL SELECT * FROM api2_feed UNION ALL SELECT * FROM rss_feed)""")
def unified_feed(spark, folder):
    feeds = unify([f(spark, folder) for f in (t.orders, t.events, t.parts, t.pages)])
    rows = public(to_records(feeds, t.as_of()))
    meta = F.col("extra_metadata")
    return rows.select(
        "source_type", "source_id", "title", F.md5("description").alias("description_md5"),
        "value", "category", F.array_join("tags", ",").alias("tags"),
        t.text_of("source_timestamp").alias("source_timestamp"),
        F.coalesce(meta["original_id"], meta["link"]).alias("origin"),
    )


@query(f"""WITH {_GOODS}, {sql.FEEDS},
feeds AS (SELECT * FROM csv_feed UNION ALL SELECT * FROM api2_feed
          UNION ALL SELECT * FROM rss_feed UNION ALL SELECT * FROM text_feed),
titles AS (SELECT title, {sql.key_of('title')} AS k FROM (SELECT DISTINCT title FROM feeds)),
named AS (SELECT title, coalesce({sql.lookup('k')}, {sql.containment('k')}) AS found FROM titles)
SELECT source_type, source_id,
       coalesce(found, CASE WHEN source_type = 'rss' THEN category END, {sql.slug('title')}) AS canonical_id
FROM feeds JOIN named USING (title)""")
def entity_resolution(spark, folder):
    feeds = unify([f(spark, folder) for f in (t.orders, t.parts, t.pages, t.documents)])
    resolved = R.resolve(feeds, GOODS, GOODS_CASCADE)
    return resolved.select("source_type", "source_id", "canonical_id")


def _named_parts(spark, folder):
    """Parts as a CSV feed whose ids have the form symbol-name."""
    return t.table(spark, folder, "part").select(
        F.replace(F.col("p_name"), F.lit(" "), F.lit("-")).alias("id"),
        F.col("p_brand").alias("title"),
        F.col("p_type").alias("symbol"),
    )


COLOURS = R.AliasBook.of([("red", "crimson-goods"), ("cold", "frozen-goods")])


@query(f"""WITH {sql.values('aliases', COLOURS.symbols)}
SELECT 'csv_' || replace(p_name, ' ', '-') AS source_id,
       coalesce({sql.lookup("split_part(p_name, ' ', 1)")}, replace(p_name, ' ', '-')) AS canonical_id
FROM part""")
def csv_symbol_ids(spark, folder):
    parsed = t.parse_csv(_named_parts(spark, folder))
    return R.resolve(parsed, COLOURS).select("source_id", "canonical_id")


TYPES = R.AliasBook.of([("promo", "promoted"), ("economy", "low-cost"), ("large", "big-size")])


@query(f"""WITH {sql.values('aliases', TYPES.aliases)}
SELECT p_partkey AS part, coalesce({sql.lookup('lower(p_type)')},
       {sql.containment('lower(p_brand)')}, {sql.slug('p_brand')}) AS canonical_id FROM part""")
def field_alias_ids(spark, folder):
    rows = _named_parts_with_key(spark, folder)
    return R.resolve(rows, TYPES).select(F.col("part").cast("long").alias("part"), "canonical_id")


def _named_parts_with_key(spark, folder):
    part = t.table(spark, folder, "part")
    return part.select(
        F.lit("api2").alias("source_type"), F.col("p_brand").alias("title"),
        t.identity(symbol=F.lit("??"), ticker=F.col("p_type")).alias("identity"),
        F.col("p_partkey").alias("part"),
    )


@query(f"""WITH {sql.FEEDS},
names AS (SELECT DISTINCT replace(p_name, ' ', '-') AS name, split_part(p_name, ' ', 1) || '.' || split_part(p_name, ' ', -1) AS symbol FROM part
          UNION SELECT DISTINCT split_part(p_name, ' ', -1), split_part(p_name, ' ', -1) FROM part),
placed AS (SELECT *, ('0x' || substr(md5(name), 1, 8))::BIGINT AS ord FROM names),
spoken AS (SELECT name, ord * 4 AS place, symbol AS alias FROM placed UNION ALL SELECT name, ord * 4 + 1, name FROM placed
           UNION ALL SELECT name, ord * 4 + 2, replace(name, '-', ' ') FROM placed UNION ALL SELECT name, ord * 4 + 3, replace(name, '-', '') FROM placed),
aliases AS (SELECT alias, min(place) AS ord, arg_max(name, place) AS canonical FROM spoken GROUP BY alias),
titles AS (SELECT source_type, source_id, title, link, {sql.key_of('title')} AS k
           FROM (SELECT * FROM api2_feed UNION ALL SELECT * FROM rss_feed)),
keys AS (SELECT k, coalesce({sql.lookup('k')}, {sql.containment('k')}) AS named FROM (SELECT DISTINCT k FROM titles))
SELECT source_type, source_id,
       coalesce(named, CASE WHEN source_type = 'rss' THEN nullif(regexp_extract(lower(link), '{sql.COIN_URL}', 1), '') END,
                {sql.slug('title')}) AS canonical_id
FROM titles LEFT JOIN keys USING (k)""")
def joined_dictionary_ids(spark, folder):
    """The cascade against a dictionary that is a table: all names of goods and all their nouns."""
    noun = F.substring_index("p_name", " ", -1)
    part = t.table(spark, folder, "part")
    named = part.select(F.replace("p_name", F.lit(" "), F.lit("-")).alias("name"),
                        F.concat(F.substring_index("p_name", " ", 1), F.lit("."), noun).alias("symbol"))
    names = named.unionByName(part.select(noun.alias("name"), noun.alias("symbol"))).distinct()
    book = names.select(F.conv(F.substring(F.md5("name"), 1, 8), 16, 10).cast("long").alias("ord"), "symbol", "name")
    feeds = unify([t.parts(spark, folder), t.pages(spark, folder)])
    return R.resolve(feeds, book).select("source_type", "source_id", "canonical_id")


@query(f"""WITH {_TEXTS}
SELECT canonical_id, count(DISTINCT source_type) AS source_count,
       string_agg(DISTINCT source_type, ',' ORDER BY source_type) AS sources, count(*) AS record_count
FROM texts WHERE canonical_id IS NOT NULL GROUP BY canonical_id HAVING count(DISTINCT source_type) > 1""")
def multi_source_entities(spark, folder):
    return E.in_many_sources(_texts(spark, folder))


@query(f"""WITH {_PARTS}
SELECT canonical_id, count(*) AS record_count FROM goods WHERE canonical_id IS NOT NULL
GROUP BY 1 HAVING count(*) > 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def multi_record_entities_top10(spark, folder):
    return E.with_many_records(_goods(spark, folder))


@query(f"""WITH {sql.FEEDS}
SELECT {sql.slug('title')} AS canonical_id, count(*) AS record_count FROM api2_feed
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
def entity_distribution_top20(spark, folder):
    return E.largest(R.resolve(t.parts(spark, folder), R.AliasBook(), (R.slug_of_title,)))


@query(f"""WITH {_PARTS} SELECT count(DISTINCT canonical_id) AS entities FROM goods""")
def distinct_entities(spark, folder):
    return E.count_ids(_goods(spark, folder))


@query(f"""WITH {_TEXTS} SELECT DISTINCT canonical_id FROM texts WHERE canonical_id IS NOT NULL""")
def distinct_entity_list(spark, folder):
    return E.distinct_ids(_texts(spark, folder))


@query(f"""WITH {_PARTS},
both_feeds AS (SELECT source_type, canonical_id FROM goods UNION ALL
         SELECT source_type, category FROM rss_feed)
SELECT source_type, count(*) AS total, count(canonical_id) AS with_canonical_id,
       round(count(canonical_id) * 100.0 / count(*), 6)::DOUBLE AS percent FROM both_feeds GROUP BY 1""")
def canonical_coverage(spark, folder):
    return E.coverage(_goods_and_pages(spark, folder))


@query(f"""WITH {_PARTS} SELECT source_type, count(*) AS unresolved FROM goods
WHERE canonical_id IS NULL GROUP BY 1""")
def unresolved_by_source(spark, folder):
    return E.unresolved_by_source(_goods_and_pages(spark, folder))


def _goods_and_pages(spark, folder):
    pages = R.resolve(t.pages(spark, folder), R.AliasBook(), LANGUAGE_CASCADE)
    return unify([_goods(spark, folder), pages])


@query(f"""WITH {_TEXTS},
shared AS (SELECT canonical_id FROM texts GROUP BY 1 HAVING count(DISTINCT source_type) > 1)
SELECT source_type, source_id, canonical_id FROM texts WHERE canonical_id IN (SELECT canonical_id FROM shared)""")
def counterpart_semi_join(spark, folder):
    shared = E.with_counterpart(_texts(spark, folder).select("source_type", "source_id", "canonical_id"))
    return shared


@query(f"""WITH {_TEXTS}
SELECT a.canonical_id, a.source_type, arg_min(b.source_type, b.source_type || '|' || b.source_id) AS other_source_type,
       arg_min(b.source_id, b.source_type || '|' || b.source_id) AS other_source_id
FROM (SELECT DISTINCT canonical_id, source_type FROM texts WHERE canonical_id IS NOT NULL) a
JOIN (SELECT canonical_id, source_type, min(source_id) AS source_id FROM texts GROUP BY 1, 2) b
  ON a.canonical_id = b.canonical_id AND a.source_type <> b.source_type GROUP BY 1, 2""")
def counterpart_records(spark, folder):
    return E.counterpart(_texts(spark, folder))


@query(f"""WITH {sql.FEEDS},
feeds AS (SELECT source_type, value, source_id, description, title FROM csv_feed
          UNION ALL SELECT source_type, value, source_id, description, title FROM api1_feed
          UNION ALL SELECT source_type, value, source_id, description, title FROM api2_feed),
named AS (SELECT source_type, value, CASE WHEN value < 100 THEN 'low' WHEN value < 1000 THEN 'middle' ELSE 'high' END AS canonical_id FROM feeds)
SELECT canonical_id, round(avg(value) FILTER (source_type = 'csv'), 4) AS value_csv,
       round(avg(value) FILTER (source_type = 'api1'), 4) AS value_api1,
       round(avg(value) FILTER (source_type = 'api2'), 4) AS value_api2,
       min(value) AS min_value, max(value) AS max_value, round(max(value) - min(value), 4) AS spread
FROM named WHERE value IS NOT NULL GROUP BY 1""")
def cross_source_values(spark, folder):
    feeds = unify([f(spark, folder) for f in (t.orders, t.events, t.parts)])
    band = F.when(F.col("value") < 100, "low").when(F.col("value") < 1000, "middle").otherwise("high")
    wide = E.values_across_sources(feeds.withColumn("canonical_id", band), ["csv", "api1", "api2"])
    rounded = [c for c in wide.columns if c.startswith("value_") or c == "spread"]
    return wide.withColumns({c: F.round(c, 4) for c in rounded})


@query(f"""SELECT doc_id, {sql.slug('text')} AS slug FROM documents""")
def slug_titles(spark, folder):
    return t.table(spark, folder, "documents").select("doc_id", slug(F.col("text")).alias("slug"))


@query(f"""SELECT page_id, {sql.LANGUAGE} AS path_entity, {sql.COIN} AS coin_entity FROM pages""")
def url_entities(spark, folder):
    url = F.col("url")
    return t.table(spark, folder, "pages").select(
        "page_id", url_slug(url, t.PATH_LANGUAGE).alias("path_entity"), url_slug(url).alias("coin_entity")
    )


@query(r"""SELECT doc_id, nullif(regexp_extract(text, '\(([A-Z]{2,6})\)', 1), '') AS in_text,
nullif(regexp_extract(source || ' (' || upper(lang) || ')', '\(([A-Z]{2,6})\)', 1), '') AS in_label FROM documents""")
def paren_symbols(spark, folder):
    label = F.concat("source", F.lit(" ("), F.upper("lang"), F.lit(")"))
    return t.table(spark, folder, "documents").select(
        "doc_id", paren_symbol(F.col("text")).alias("in_text"), paren_symbol(label).alias("in_label")
    )


@query(f"""SELECT page_id, 'rss_' || substr(md5(url), 1, 16) AS by_link, 'rss_' || page_id AS by_guid,
'rss_' || substr(md5(json_object('page_id', page_id::VARCHAR, 'url', url)::VARCHAR), 1, 16) AS by_content FROM pages""")
def source_ids(spark, folder):
    none = S.null_text()
    id, url = F.col("page_id").cast("string"), F.col("url")
    content = S.content_text({"url": url, "page_id": id})
    return t.table(spark, folder, "pages").select(
        "page_id",
        S.natural_source_id("rss", id=none, link=url).alias("by_link"),
        S.natural_source_id("rss", id=none, guid=id, link=url).alias("by_guid"),
        S.natural_source_id("rss", id=none, content=content).alias("by_content"),
    )


@query(f"""WITH {_PARTS},
records AS (SELECT source_id, CASE WHEN category IN ('PROMO', 'SMALL') THEN 'known-' || lower(category) END AS before, title
            FROM api2_feed)
SELECT source_id, coalesce(before, {sql.containment(sql.key_of('title'))}, {sql.slug('title')}) AS canonical_id,
       before IS NULL AS was_missing FROM records""")
def backfill_ids(spark, folder):
    known = F.when(F.col("category").isin("PROMO", "SMALL"), F.concat(F.lit("known-"), F.lower("category")))
    records = to_records(t.parts(spark, folder).withColumn("canonical_id", known), t.as_of())
    return R.backfill(records, GOODS).select(
        "source_id", "canonical_id", (~F.col("category").isin("PROMO", "SMALL")).alias("was_missing")
    )


@query(f"""WITH {sql.FEEDS},
fixes AS (SELECT 'api_api2_' || l_partkey AS source_id, 'returned' AS canonical_id FROM lineitem
          WHERE l_returnflag = 'R' GROUP BY 1 HAVING sum(l_quantity) > 250)
SELECT f.source_id, coalesce(x.canonical_id, {sql.slug('f.title')}) AS canonical_id
FROM api2_feed f LEFT JOIN fixes x USING (source_id)""")
def identity_override(spark, folder):
    named = R.resolve(t.parts(spark, folder), R.AliasBook(), (R.slug_of_title,))
    fixes = (
        t.table(spark, folder, "lineitem").filter("l_returnflag = 'R'").groupBy("l_partkey")
        .agg(F.sum("l_quantity").alias("q")).filter("q > 250")
        .select(F.concat(F.lit("api_api2_"), F.col("l_partkey").cast("string")).alias("source_id"),
                F.lit("returned").alias("canonical_id"))
    )
    return R.override(named.select("source_id", "canonical_id"), fixes)


@query("""SELECT coalesce(o_orderpriority, 'all') AS source_type, count(DISTINCT o_custkey) AS entities, TRUE AS close
FROM orders GROUP BY ROLLUP (o_orderpriority)""")
def entity_sketches(spark, folder):
    """Different entities of each source and of all from sketches by year, beside the exact numbers: within 6 % of them."""
    orders = t.table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("source_type"), F.col("o_custkey").cast("string").alias("canonical_id"), F.year("o_orderdate").alias("year"))
    about = E.estimated_ids(E.sketches(orders, "year")).select(F.coalesce("source_type", F.lit("all")).alias("source_type"), F.col("entities").alias("about"))
    exact = orders.rollup("source_type").agg(F.count_distinct("canonical_id").alias("entities"))
    exact = exact.select(F.coalesce("source_type", F.lit("all")).alias("source_type"), "entities")
    return exact.join(about, "source_type").select("source_type", "entities", (F.abs(F.col("about") - F.col("entities")) <= F.col("entities") * 0.06).alias("close"))
