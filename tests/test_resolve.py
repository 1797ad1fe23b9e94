import pytest
from pyspark.sql import functions as F

from feedweave.operators import resolve as R
from feedweave.operators.normalize import ALIAS_FIELDS, identity

GOLDENS = [
    ("csv", "Bitcoin", {"id": "btc-bitcoin"}, "bitcoin"),
    ("api_api1", "Bitcoin", {"symbol": "BTC"}, "bitcoin"),
    ("rss", "Ethereum News", {}, "ethereum"),
    ("api_api1", "Ethereum", {"symbol": "ETH"}, "ethereum"),
    ("csv", "Solana", {"id": "sol-solana"}, "solana"),
    ("csv", "X", {"id": "foo-bar"}, "foo-bar"),
    ("csv", "Test Product", {"id": "1"}, "test-product"),
    ("api_api1", "zzz", {"symbol": "??", "ticker": "ETH"}, "ethereum"),
    ("rss", "Hello (XRP) zz", {}, "ripple"),
    ("rss", "Top stories", {}, "optimism"),
    ("rss", "", {}, "bitcoin"),
    ("rss", "Zebra %% gym 42", {"link": "https://x/coins/ltc/a"}, "litecoin"),
    ("rss", "Zebra gym 42", {"link": "https://x/coin/foo-9"}, "foo-9"),
    ("rss", "Zebra  --  gym! 42", {"link": "https://x/"}, "zebra-gym-42"),
    ("csv", "!!!", {"id": "7"}, "unknown"),
]


def parsed(spark, cases):
    names = ["id", "link", *ALIAS_FIELDS]
    rows = [(i, s, t, *[f.get(n) for n in names]) for i, (s, t, f, *_) in enumerate(cases)]
    schema = "i int, source_type string, title string, " + ", ".join(f"{n} string" for n in names)
    df = spark.createDataFrame(rows, schema)
    clues = identity(id=F.col("id"), link=F.col("link"), **{f: F.col(f) for f in ALIAS_FIELDS})
    return df.select("i", "source_type", "title", clues.alias("identity"))


def answers(df):
    return [r["canonical_id"] for r in df.orderBy("i").select("canonical_id").collect()]


def test_dictionary_size():
    assert len(R.CRYPTO.symbols) == 42
    assert len(R.CRYPTO.aliases) == 102


def test_goldens(spark):
    df = parsed(spark, GOLDENS)
    assert answers(R.resolve(df)) == [g[3] for g in GOLDENS]


@pytest.fixture(scope="module")
def symbol_rows(spark):
    rows = [(i, s, n) for i, (s, n) in enumerate(R.CRYPTO_SYMBOLS)]
    return spark.createDataFrame(rows, "ord long, symbol string, name string")


def test_goldens_with_joined_dictionary(spark, symbol_rows):
    df = parsed(spark, GOLDENS)
    assert answers(R.resolve(df, symbol_rows)) == [g[3] for g in GOLDENS]


def test_alias_rows_match_literal_book(spark, symbol_rows):
    rows = R.alias_rows(symbol_rows).orderBy("ord").collect()
    assert [(r["alias"], r["canonical"]) for r in rows] == list(R.CRYPTO.aliases.items())


def test_joined_and_literal_dictionary_agree_on_page_titles(spark, symbol_rows):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    titles = pages.select(
        F.lit("rss").alias("source_type"), F.col("url").alias("link"),
        F.regexp_extract("html", "(?is)<title[^>]*>(.*?)</title>", 1).alias("title"),
    ).unionByName(
        docs.select(F.lit("csv").alias("source_type"), F.lit(None).cast("string").alias("link"), "lang")
        .withColumnRenamed("lang", "title")
    )
    df = titles.select("source_type", "title", identity(link=F.col("link")).alias("identity")).withColumn(
        "i", F.row_number().over(__import__("pyspark").sql.Window.orderBy("source_type", "title", "identity.link"))
    )
    assert answers(R.resolve(df)) == answers(R.resolve(df, symbol_rows))


def test_a_book_in_memory_and_as_rows_give_the_same_answers(spark):
    titles = ["Bitcoin", "buy (eth) now", "the-graph", "", None, "bit", "x name-7 y", "s12", "name 299"]
    rows = [("csv", t, {"id": f"s{i}-x"}) for i, t in enumerate(titles)] + [("rss", t, {"link": "https://x/coin/s5"}) for t in titles]
    rows += [("api1", "Q", {"symbol": " S9 "}), ("api1", "Q", {"currency": "name-4"}), ("api1", None, {})]
    book = R.AliasBook.of([*R.CRYPTO_SYMBOLS, *((f"s{i}", f"name-{i}") for i in range(300))])
    loud = lambda clues, _: F.when(clues.title == "Q", F.lit("own"))
    cascade = (*R.CASCADE[:2], loud, *R.CASCADE[2:5], R.url_entity("/coin/([a-z0-9]+)"), R.slug_of_title)
    assert answers(R.resolve(parsed(spark, rows), book.table(spark), cascade)) == answers(R.resolve(parsed(spark, rows), book, cascade))


def test_own_strategies_ask_either_kind_of_book(spark, symbol_rows):
    """The first word of the title as an alias: the same answers from memory and from rows."""
    def first_word(clues, book):
        return book.alias(F.substring_index(clues.title_key, " ", 1))

    df = parsed(spark, [("rss", "Bitcoin rises", {}), ("rss", "Rises bitcoin", {}), ("rss", "ETH!", {}), ("rss", None, {})])
    cascade = (first_word, R.slug_of_title)
    want = ["bitcoin", "rises-bitcoin", "eth", None]
    assert answers(R.resolve(df, R.CRYPTO, cascade)) == want
    assert answers(R.resolve(df, symbol_rows, cascade)) == want

    def looks_inside(clues, book):
        return F.lit(book.aliases["btc"])

    with pytest.raises(AttributeError, match="alias"):
        R.resolve(df, symbol_rows, (looks_inside,))


def test_one_join_with_the_dictionary(spark, symbol_rows):
    """All look-ups of the cascade meet the dictionary in one join and come back in another; null keys meet nothing."""
    df = parsed(spark, GOLDENS)
    plain = [s for s in R.CASCADE if s is not R.alias_in_title]
    plan = R.resolve(df, symbol_rows, plain)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2 and "isnotnull(key" in plan


@pytest.mark.parametrize("aliases", [["a", "bc", "abc", "cab", "aab b", "caa", "zz"], ["", "ab"], ["", ""], []])
def test_containment_is_complete(spark, aliases):
    import itertools

    titles = ["".join(x) for n in range(5) for x in itertools.product("abc", repeat=n)]
    rows = spark.createDataFrame([(a, i, f"c{i}") for i, a in enumerate(dict.fromkeys(aliases))], "key string, ord long, canonical string")
    got = {r["key"]: r["canonical"] for r in R.contained(spark.createDataFrame([(t,) for t in titles], "key string"), rows).collect()}
    want = {}
    for t in titles:
        hits = [f"c{i}" for i, a in enumerate(dict.fromkeys(aliases)) if a in t or t in a]
        if hits:
            want[t] = hits[0]
    assert got == want


def test_containment_expands_no_more_than_the_grams_of_titles(spark):
    """Neither side is cut into all its pieces: one long alias and one long title cost their grams."""
    text = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(400))
    df = spark.createDataFrame([(text + "x",)], "key string")
    book = spark.createDataFrame([(text[:300], 0, "long"), ("qqq", 1, "short")], "key string, ord long, canonical string")
    assert R.contained(df, book).collect()[0]["canonical"] == "long"
    grams = df.select(F.size(R._grams(F.col("key"), F.array(F.lit(R.GRAM)))).alias("n")).first()["n"]
    assert grams <= 399


def test_own_strategy_goes_first(spark):
    def shouted(clues, book):
        return F.when(F.upper(clues.title) == clues.title, F.lit("loud"))

    df = parsed(spark, [("csv", "HEY", {"id": "btc-bitcoin"}), ("csv", "hey", {"id": "btc-bitcoin"})])
    assert answers(R.resolve(df, cascade=(shouted, *R.CASCADE))) == ["loud", "bitcoin"]


def test_backfill_and_override(spark):
    df = spark.createDataFrame(
        [
            ("csv", "a", None, "Bitcoin", {"original_id": "btc-bitcoin"}),
            ("csv", "b", "kept", "Bitcoin", {"original_id": "btc-bitcoin"}),
            ("csv", "c", None, "X", {"original_id": "foo-bar"}),
            ("rss", "d", None, "Zebra gym 42", {"link": "https://x/coin/foo-9"}),
        ],
        "source_type string, source_id string, canonical_id string, title string, extra_metadata map<string,string>",
    )
    filled = R.backfill(df)
    assert filled.columns == df.columns
    got = {r["source_id"]: r["canonical_id"] for r in filled.collect()}
    assert got == {"a": "bitcoin", "b": "kept", "c": "foo-bar", "d": "foo-9"}
    fixes = spark.createDataFrame([("d", "right")], "source_id string, canonical_id string")
    got = {r["source_id"]: r["canonical_id"] for r in R.override(filled, fixes).collect()}
    assert got == {"a": "bitcoin", "b": "kept", "c": "foo-bar", "d": "right"}
