import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns with names that the operators use themselves.
CLASHING = "size bigint, row bigint, key string, part string, n_words string, n_tokens string, print string, node string, kept string, text_ string"


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty, white, very long and repeated texts, null and repeated ids, clashing columns."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", None, None), (3, " \n\t ", None, "a", 4), (4, "One short text.", "en", "b", 15),
        (5, "One short text.", "en", "b", 15), (5, "One short text.", "en", "b", 15), (6, long, "de", "b", len(long)), (7, f"before {passage} after", "en", "c", 1),
        (8, f"other words, then {passage}\nand   more", "en", "c", 1), (9, passage.upper(), "en", "c", 1), (None, f"x {passage}", "en", "ä", 1), (None, None, None, None, None),
        (10, "a  b\n\nc\td é <|endoftext|> 'Re  \n\n日本語 </s>", "fr", "a", 1), (11, "Ma Ma Ma Ma Ma Ma Ma Ma Ma Ma Ma Ma", "en", "a", 1), (12, "x", "en", "z", 1),
    ]
    plain = spark.createDataFrame(rows, SCHEMA)
    extra = CLASHING.replace(",", "").split()
    return plain.selectExpr("*", *(f"cast('q' as string) as {n}" if t == "string" else f"cast(7 as bigint) as {n}" for n, t in zip(extra[::2], extra[1::2])))


@pytest.fixture(scope="session")
def odd_rows(odd):
    return [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
