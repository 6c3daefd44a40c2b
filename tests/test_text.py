"""Word counts, grep, matching lines, inverted index, visitor top-k."""

from pyspark.sql import functions as F

from quarry.operators import ordering, text
from tests.conftest import executed_plan, rows


def _docs(spark, lines):
    return spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "doc_id long, text string")


def test_word_count_splits_lines_first(spark):
    df = _docs(spark, ["the cow\njumped over the moon", " a  b "])
    out = dict((r["word"], r["count"]) for r in text.word_count(df).collect())
    assert out == {"the": 2, "cow": 1, "jumped": 1, "over": 1, "moon": 1, "a": 1, "b": 1}
    assert dict(text.word_count(df).dtypes)["count"] == "bigint"


def test_word_count_tokenizer_choice(spark):
    df = _docs(spark, ["a\tb"])
    assert rows(text.word_count(df, tokenizer="collapse"), "word") == [("a\tb",)]
    assert rows(text.word_count(df, tokenizer="tokenizer"), "word") == [("a",), ("b",)]


def test_grep_count(spark):
    df = _docs(spark, ["the other theme", "nothing here then"])
    assert rows(text.grep_count(df, "the")) == [("other", 1), ("the", 1), ("theme", 1), ("then", 1)]


def test_matching_lines_once_per_word_ordered(spark):
    # FIXTURES A6: the first line matches twice
    df = _docs(spark, ["10:01 srv2 ERR disk ERR", "10:00 srv1 OK none"])
    m = text.matching_lines(df, "ERR")
    assert rows(m, "sort_key", "line") == [("10:01 ERR", "10:01 srv2 ERR disk ERR")] * 2
    assert [r["line"] for r in text.lines_ordered_by_key(m).collect()] == ["10:01 srv2 ERR disk ERR"] * 2


def test_matching_lines_short_line(spark):
    df = _docs(spark, ["ERR x"])
    assert rows(text.matching_lines(df, "ERR"), "sort_key") == [("ERR ",)]


def test_inverted_index_fixture(spark):
    # FIXTURES A7: u1,a,b / u2,b,c
    df = spark.createDataFrame([("u1,a,b",), ("u2,b,c",)], "line string")
    parsed = df.select(F.split("line", ",").alias("p")).select(
        F.element_at("p", 1).alias("url"), F.slice("p", 2, 100).alias("terms"))
    out = rows(text.inverted_index(parsed, "url", "terms"), "term", "urls")
    assert out == [("a", "u1"), ("b", "u1,u2"), ("c", "u2")]


def test_inverted_index_blocks_are_bounded(spark):
    df = spark.createDataFrame([(i, ["hot", f"t{i % 3}"]) for i in range(25)], "doc_id long, terms array<string>")
    by_id = text.inverted_index(df, "doc_id", "terms", block_col="doc_id", block_size=10)
    by_rank = text.inverted_index(df.withColumn("url", F.format_string("u%03d", "doc_id")), "url", "terms",
                                  block_size=10)
    for out in (by_id, by_rank):
        hot = sorted((r["block"], r["urls"]) for r in out.where("term = 'hot'").collect())
        assert [b for b, _ in hot] == [0, 1, 2]
        assert all(len(u.split(",")) <= 10 for _, u in hot)
        assert sum(len(u.split(",")) for _, u in hot) == 25


def test_visitor_width_filter_and_top(spark):
    # FIXTURES A9 shape: rows with 19, 20, 21 fields; POTUS in field 19
    def rec(last, first, n, comment):
        f = [last, first] + ["x"] * (n - 2)
        if n > 19:
            f[19] = comment
        return (",".join(f),)

    data = [rec("Doe", "Jo", 20, "POTUS"), rec("Doe", "Jo", 21, "met POTUS"), rec("Roe", "Al", 19, "POTUS"),
            rec("Roe", "Al", 20, "none"), rec("Poe", "Ed", 20, "POTUS")]
    df = spark.createDataFrame(data, "line string").select(F.split("line", ",").alias("f"))
    keep = df.where(text.width_and_contains("f", 20, 19, "POTUS"))
    names = text.name_count(keep, F.concat_ws(", ", F.col("f")[0], F.col("f")[1]))
    assert rows(names) == [("Doe, Jo", 2), ("Poe, Ed", 1)]
    strict = df.where(text.width_and_contains("f", 21, 19, "POTUS"))  # the Scala twin's '> 20'
    assert strict.count() == 1
    top = ordering.top_k(names, 1, "count", "name").collect()
    assert [tuple(r) for r in top] == [("Doe, Jo", 2)]


def test_posting_blocks_are_built_a_block_at_a_time_in_arrow(spark):
    data = [(i, None if i == 7 else [f"t{i % 3}", "all"] + ([None] if i == 4 else [])) for i in range(25)] + [(3, ["again", "all"])]
    blocks = text.posting_blocks(spark.createDataFrame(data, "rank long, terms array<string>"), "rank", "terms", 10)
    assert "MapInArrow" in executed_plan(blocks) and "collect_list" not in executed_plan(blocks)
    expected = {}
    for rank, terms in sorted(data, key=lambda r: r[0]):
        for term in terms or []:
            expected.setdefault((term, rank // 10), []).append(rank)
    got = {(r["term"], r["block"]): (r["ranks"], r["n"]) for r in text.decode_postings(blocks).collect()}
    assert got == {k: (v, len(v)) for k, v in expected.items()}


def test_index_joins_sort_no_postings(spark):
    docs = spark.createDataFrame([(f"u{i}", ["all", f"t{i % 3}"]) for i in range(30)], "url string, terms array<string>")
    plan = executed_plan(text.inverted_index(docs, "url", "terms", block_size=4))
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
