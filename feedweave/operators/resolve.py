"""Canonical entity ids: an ordered cascade of matching strategies."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedweave.functions import scalars as S
from feedweave.functions.text import COIN_URL, paren_symbol, slug, url_slug
from feedweave.operators.normalize import ALIAS_FIELDS

# Ticker symbols and the entities they stand for, in matching order.
CRYPTO_SYMBOLS = [
    ("btc", "bitcoin"),
    ("eth", "ethereum"),
    ("usdt", "tether"),
    ("bnb", "binance-coin"),
    ("sol", "solana"),
    ("xrp", "ripple"),
    ("usdc", "usd-coin"),
    ("ada", "cardano"),
    ("avax", "avalanche"),
    ("doge", "dogecoin"),
    ("dot", "polkadot"),
    ("matic", "polygon"),
    ("shib", "shiba-inu"),
    ("dai", "dai"),
    ("trx", "tron"),
    ("link", "chainlink"),
    ("uni", "uniswap"),
    ("atom", "cosmos"),
    ("ltc", "litecoin"),
    ("xlm", "stellar"),
    ("etc", "ethereum-classic"),
    ("bch", "bitcoin-cash"),
    ("near", "near-protocol"),
    ("algo", "algorand"),
    ("vet", "vechain"),
    ("icp", "internet-computer"),
    ("hbar", "hedera"),
    ("apt", "aptos"),
    ("arb", "arbitrum"),
    ("op", "optimism"),
    ("fil", "filecoin"),
    ("imx", "immutable-x"),
    ("ldo", "lido-dao"),
    ("crv", "curve"),
    ("grt", "the-graph"),
    ("aave", "aave"),
    ("mkr", "maker"),
    ("snx", "synthetix"),
    ("rune", "thorchain"),
    ("inj", "injective"),
    ("ftm", "fantom"),
    ("tia", "celestia"),
]

@dataclass(frozen=True)
class AliasBook:
    """A dictionary in memory, kept in matching order. It becomes a constant of the plan, so it should be small;
    ``table`` gives the same dictionary as rows, which are joined."""

    symbols: dict[str, str] = field(default_factory=dict)
    aliases: dict[str, str] = field(default_factory=dict)

    @staticmethod
    def of(pairs: Iterable[tuple[str, str]]) -> AliasBook:
        """Symbol, name, name with spaces and name run together all lead to the name.

        A repeated alias keeps its first place in the order and its last meaning.
        """
        symbols: dict[str, str] = {}
        aliases: dict[str, str] = {}
        for symbol, name in pairs:
            symbols[symbol] = name
            for alias in (symbol, name, name.replace("-", " "), name.replace("-", "")):
                aliases[alias] = name
        return AliasBook(symbols, aliases)

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(kind, k, i, c) for kind, part in (("symbol", self.symbols), ("alias", self.aliases)) for i, (k, c) in enumerate(part.items())]
        return spark.createDataFrame(rows, "kind string, key string, ord long, canonical string")

    def symbol(self, key: Column) -> Column:
        return _lookup(self.symbols, key)

    def alias(self, key: Column) -> Column:
        return _lookup(self.aliases, key)

    def containing(self, key: Column) -> Column:
        """Entity of the first alias, in order, that contains the key or is contained in it."""
        if not self.aliases:
            return S.null_text()
        listed = [{"alias": a, "canonical": c} for a, c in self.aliases.items()]
        entries = F.from_json(F.lit(json.dumps(listed)), "array<struct<alias:string,canonical:string>>")
        hits = F.filter(entries, lambda e: F.contains(key, e["alias"]) | F.contains(e["alias"], key))
        first = F.get(hits, F.lit(0))["canonical"]
        if "" in self.aliases:
            return first
        # Most titles name nothing: one pattern and one search rule them out before the list is
        # walked. A title with a line break may slip through the search and is then walked too.
        possible = F.contains(F.lit("\n".join(self.aliases)), key) | key.rlike(_any_of(self.aliases))
        return F.when(possible, first)


class TableBook:
    """A dictionary of rows, as strategies see it: what they ask is noted, and a join answers it.

    The answer is a column of the row, like that of a dictionary in memory, so any strategy works with either. It is there
    once all have been asked; a strategy cannot make an answer part of another question.
    """

    def __init__(self):
        self.asked: list[tuple[str, Column]] = []

    def _ask(self, kind: str, key: Column) -> Column:
        self.asked.append((kind, key))
        return F.try_element_at(F.col("_found"), F.lit(len(self.asked) - 1))

    def symbol(self, key: Column) -> Column:
        return self._ask("symbol", key)

    def alias(self, key: Column) -> Column:
        return self._ask("alias", key)

    def containing(self, key: Column) -> Column:
        return self._ask("within", key)

    def __getattr__(self, name: str):
        raise AttributeError(f"a dictionary of rows has no {name}: ask it by symbol(key), alias(key) or containing(key)")


CRYPTO = AliasBook.of(CRYPTO_SYMBOLS)


def alias_rows(pairs: DataFrame) -> DataFrame:
    """The same expansion for a dictionary held as rows (ord, symbol, name)."""
    name = F.col("name")
    spoken = F.array(
        F.col("symbol"), name, F.replace(name, F.lit("-"), F.lit(" ")),
        F.replace(name, F.lit("-"), F.lit("")),
    )
    place = F.col("ord") * 4 + F.col("pos")
    return (
        pairs.select("ord", "name", F.posexplode(spoken).alias("pos", "alias"))
        .groupBy("alias")
        .agg(F.min(place).alias("ord"), F.max_by("name", place).alias("canonical"))
    )


@dataclass(frozen=True)
class Clues:
    """The columns a strategy may look at."""

    source_type: Column
    title: Column
    title_key: Column
    identity: Column


Book = AliasBook | TableBook
Strategy = Callable[[Clues, Book], Column]


def _lookup(entries: dict[str, str], key: Column) -> Column:
    if not entries:
        return S.null_text()
    # One literal text, folded to a constant map when the plan is optimised.
    literal = F.from_json(F.lit(json.dumps(entries)), "map<string,string>")
    # Most keys are in no dictionary: a hashed set tells, where a map is searched from its beginning.
    return F.when(key.isin(list(entries)), F.try_element_at(literal, key))


def _any_of(words: Iterable[str]) -> str:
    """Pattern that finds any of the words, branching on the first character."""
    tails: dict[str, list[str]] = {}
    for word in sorted(words):
        tails.setdefault(word[0], []).append(re.escape(word[1:]))
    return "|".join(f"{re.escape(head)}(?:{'|'.join(rest)})" for head, rest in tails.items())


def symbol_of_id(clues: Clues, book: Book) -> Column:
    """CSV ids of the form symbol-name; an unknown symbol keeps the id as it is."""
    id = clues.identity["id"]
    fits = (clues.source_type == "csv") & F.contains(id, F.lit("-"))
    return F.coalesce(book.symbol(F.when(fits, F.lower(F.substring_index(id, "-", 1)))), F.when(fits, id))


def alias_of_field(clues: Clues, book: Book) -> Column:
    """The first naming field whose value is a known alias."""
    return F.coalesce(*[book.alias(S.strip(F.lower(clues.identity[f]))) for f in ALIAS_FIELDS])


def alias_of_title(clues: Clues, book: Book) -> Column:
    return book.alias(clues.title_key)


def alias_in_parens(clues: Clues, book: Book) -> Column:
    return book.alias(F.lower(paren_symbol(clues.title)))


def alias_in_title(clues: Clues, book: Book) -> Column:
    """First alias, in dictionary order, that contains the title or is contained in it."""
    return book.containing(clues.title_key)


@dataclass(frozen=True)
class UrlEntity:
    """Entity named in the link: a known alias, else the matched part itself."""

    pattern: str = COIN_URL
    source_types: tuple[str, ...] = ("rss",)

    def __call__(self, clues: Clues, book: Book) -> Column:
        part = F.when(clues.source_type.isin(list(self.source_types)), url_slug(clues.identity["link"], self.pattern))
        return F.coalesce(book.alias(part), part)


def url_entity(pattern: str = COIN_URL, source_types: Sequence[str] = ("rss",)) -> Strategy:
    return UrlEntity(pattern, tuple(source_types))


def slug_of_title(clues: Clues, book: Book) -> Column:
    return slug(clues.title)


CASCADE: tuple[Strategy, ...] = (
    symbol_of_id, alias_of_field, alias_of_title, alias_in_parens, alias_in_title,
    url_entity(), slug_of_title,
)


def resolve(
    parsed: DataFrame, book: AliasBook | DataFrame = CRYPTO, cascade: Sequence[Strategy] = CASCADE
) -> DataFrame:
    """Add ``canonical_id``: the answer of the first strategy that has one.

    ``book`` is a dictionary in memory, which makes a narrow projection whatever the size of the feed, or rows of any
    number: (ord, symbol, name), or (kind, key, ord, canonical) as ``AliasBook.table`` gives. Own strategies are functions from
    the clues and the book to a column and can be put anywhere in the cascade; they ask either kind of book alike.
    """
    keyed = parsed.withColumn("_title_key", S.strip(F.lower("title")))
    clues = Clues(F.col("source_type"), F.col("title"), F.col("_title_key"), F.col("identity"))
    if isinstance(book, AliasBook):
        answers = [strategy(clues, book) for strategy in cascade]
    else:
        asking = TableBook()
        answers = [strategy(clues, asking) for strategy in cascade]
        keyed = _answered(keyed, asking.asked, _dictionary(book)) if asking.asked else keyed
    return keyed.withColumn("canonical_id", F.coalesce(*answers)).select(
        *[c for c in parsed.columns if c != "canonical_id"], "canonical_id")


def _dictionary(book: DataFrame) -> DataFrame:
    """``kind, key, ord, canonical``: each alias and each symbol once."""
    if "kind" in book.columns:
        return book.select("kind", "key", "ord", "canonical")
    symbols = book.groupBy(F.col("symbol").alias("key")).agg(
        F.max("ord").alias("ord"), F.max_by("name", "ord").alias("canonical"))
    aliases = alias_rows(book).select(F.col("alias").alias("key"), "ord", "canonical")
    return symbols.withColumn("kind", F.lit("symbol")).unionByName(aliases.withColumn("kind", F.lit("alias")))


def _answered(rows: DataFrame, asked: list[tuple[str, Column]], dictionary: DataFrame) -> DataFrame:
    """``rows`` with ``_found``: the answers to what was asked, by the place of the question.

    The keys a row asks for are one value. Each such value that occurs is taken apart once, its keys (none of them null) meet
    the dictionary in one join, and the answers go back to the rows in another. Rows without any key go past both.
    """
    keys = F.array(*[key.cast("string") for _, key in asked])
    # Something of its own for each row that asks nothing, so that they do not meet in one task.
    given = [F.col(c) for c in ("source_type", "title", "identity", "source_id") if c in rows.columns]
    alone = F.array(F.lit(None).cast("string"), *[F.xxhash64(*given).cast("string")] * len(asked))
    # The one-element explode keeps what looks at the keys above the work of making them.
    rows = rows.withColumns({"_keys": F.explode(F.array(keys)), "_alone": alone})
    rows = rows.withColumn("_keys", F.when(F.exists("_keys", lambda k: k.isNotNull()), F.col("_keys")).otherwise(F.col("_alone"))).drop("_alone")
    kinds = F.array(*[F.lit(kind) for kind, _ in asked])
    sets = rows.select("_keys").filter(F.size("_keys") == len(asked)).distinct()
    questions = sets.select("_keys", F.posexplode("_keys").alias("place", "key")).filter("key IS NOT NULL").select(
        "_keys", "place", F.get(kinds, F.col("place")).alias("kind"), "key")
    answers = dictionary.select("kind", "key", "canonical")
    if any(kind == "within" for kind, _ in asked):
        titles = questions.filter("kind = 'within'").select("key").distinct()
        within = contained(titles, dictionary.filter("kind = 'alias'").select("key", "ord", "canonical"))
        answers = answers.unionByName(within.select(F.lit("within").alias("kind"), "key", "canonical"))
    found = questions.join(answers, ["kind", "key"]).groupBy("_keys").agg(
        F.map_from_entries(F.collect_list(F.struct("place", "canonical"))).alias("_found"))
    return rows.join(found, "_keys", "left")


GRAM = 3


def _grams(text: Column, sizes: Column) -> Column:
    """Distinct pieces of a text that are as long as one of a few sizes."""
    return F.array_distinct(F.flatten(F.transform(F.filter(sizes, lambda n: n <= F.length(text)), lambda n: F.transform(
        F.sequence(F.lit(1), F.length(text) - n + 1), lambda p: F.substring(text, p, n)))))


def _inside(needles: DataFrame, hays: DataFrame) -> DataFrame:
    """``needle, hay`` for every needle (not empty) in every text that holds it.

    A needle stands in an index under that of its pieces of ``GRAM`` characters which the fewest texts have (a shorter one under
    itself); one with a piece that no text has is in none. Texts look up the pieces they have, and what they find is verified.
    """
    size = F.least(F.length("needle"), F.lit(GRAM))
    needles = needles.filter("needle <> ''").withColumn("size", size)
    wanted = needles.agg(F.array_sort(F.collect_set("size")).alias("sizes"))
    probes = hays.withColumn("sizes", wanted.scalar()).select("hay", F.explode(_grams(F.col("hay"), F.col("sizes"))).alias("gram"))
    spread = probes.groupBy("gram").agg(F.count("*").alias("n"))
    pieces = needles.withColumn("grams", _grams(F.col("needle"), F.array("size")))
    index = (pieces.select("needle", F.size("grams").alias("all"), F.explode("grams").alias("gram")).join(spread, "gram")
             .groupBy("needle").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"), F.count("*").alias("met"), F.max("all").alias("all"))
             .filter("met = all").select("gram", "needle"))
    return index.join(probes, "gram").filter(F.contains("hay", "needle")).select("needle", "hay")


def contained(titles: DataFrame, aliases: DataFrame) -> DataFrame:
    """``key, canonical`` of the titles (``key``, each once) that hold an alias or lie in one: the first alias in order."""
    named = titles.select(F.col("key").alias("title"))
    known = aliases.select(F.col("key").alias("alias"), "ord", "canonical")
    holds = _inside(aliases.select(F.col("key").alias("needle")), titles.select(F.col("key").alias("hay"))).toDF("alias", "title")
    lies = _inside(titles.select(F.col("key").alias("needle")), aliases.select(F.col("key").alias("hay"))).toDF("title", "alias")
    met = holds.select("title", "alias").unionByName(lies).join(known, "alias").select("title", "ord", "canonical")
    # An empty title lies in every alias, and an empty alias in every title.
    first = F.min(F.struct("ord", "canonical")).alias("first")
    empty_alias, any_alias = known.filter("alias = ''").agg(first), known.agg(first)
    always = F.when(F.col("title") == "", any_alias.scalar()).otherwise(empty_alias.scalar())
    rest = named.select("title", always.alias("first")).filter("first IS NOT NULL").select("title", "first.ord", "first.canonical")
    return met.unionByName(rest).groupBy(F.col("title").alias("key")).agg(F.min_by("canonical", "ord").alias("canonical"))


def as_parsed(records: DataFrame) -> DataFrame:
    """Stored rows with their clues rebuilt from metadata, ready to be resolved again."""
    meta = F.col("extra_metadata")

    def entry(*names: str) -> Column:
        return F.coalesce(*[F.try_element_at(meta, F.lit(n)) for n in names])

    return records.withColumn(
        "identity",
        F.struct(
            entry("id", "original_id").alias("id"),
            entry("link").alias("link"),
            *[entry(f).alias(f) for f in ALIAS_FIELDS],
        ),
    )


def backfill(
    records: DataFrame, book: AliasBook | DataFrame = CRYPTO, cascade: Sequence[Strategy] = CASCADE
) -> DataFrame:
    """Resolve the rows without a canonical id and leave the others untouched, in one pass."""
    known = F.col("_known")
    fresh = resolve(
        as_parsed(records).withColumnRenamed("canonical_id", "_known"), book, cascade
    )
    return fresh.withColumn("canonical_id", F.coalesce(known, "canonical_id")).select(
        *records.columns
    )


def override(records: DataFrame, overrides: DataFrame) -> DataFrame:
    """Manual corrections (source_id, canonical_id), one per record at most."""
    fixes = overrides.select("source_id", F.col("canonical_id").alias("_fixed"))
    return (
        records.join(fixes, "source_id", "left")
        .withColumn("canonical_id", F.coalesce("_fixed", "canonical_id"))
        .select(*records.columns)
    )
