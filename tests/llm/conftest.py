import pytest

LONG = " ".join(f"word{i % 97} thing{i % 89}" for i in range(40_000))
COPY = "the quick brown fox jumps over the lazy dog while seven wizards sing a song of summer rain and old stone walls"
#: a near copy: one word of 22 differs at the end, so 17 of 19 shingles are shared
NEAR = COPY.replace("walls", "towers")
LINE = "this very line of more than forty code points comes up again"

#: (doc_id, text): nulls, empty and blank texts, a long text, ties and repeated rows
ROWS = [
    (5, COPY), (3, COPY.upper()), (9, NEAR), (3, COPY.upper()), (None, COPY), (None, None), (7, None), (8, ""), (10, "  \n\t "),
    (11, "ab"), (12, "ab"), (13, LONG), (14, f"{LINE}\nown line number fourteen stays as it is, surely"), (15, f"  {LINE.upper()} \n{LINE}"),
    (16, LINE), (17, f"start\n{LINE}"), (18, f"{LINE}\r\nend"), (2, f"{LINE}\n\n"), (20, "▁ <|endoftext|> &amp; <s> é́ 日本語 🙂  two  spaces "),
    (21, "idiot " * 30), (22, "x" * 3000),
]
#: other columns, under names that the operators use inside
EXTRA = {"lang": "string", "source": "string", "n_chars": "bigint", "score": "double", "word": "string", "node": "bigint", "key": "string",
         "range": "int", "ghost": "boolean", "dropped": "string", "hits": "string", "digest": "string", "_id": "bigint", "label": "int", "a": "int", "n": "int"}
SCHEMA = "doc_id bigint, text string, " + ", ".join(f"`{k}` {v}" for k, v in EXTRA.items())


def make(spark, rows):
    return spark.createDataFrame([(*r, *([None] * len(EXTRA))) for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def docs(spark):
    return make(spark, ROWS)


@pytest.fixture(scope="session")
def nothing(spark):
    return make(spark, [])
