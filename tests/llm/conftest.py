from __future__ import annotations

import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents with copies, near copies, ties, nulls, empty and long texts, a hot source."""
    def text(seed: int, words: int) -> str:
        return " ".join(f"w{(seed * 7919 + i * i * 31 + i) % 997}" for i in range(words))

    rows = []
    for i in range(120):
        source = "hot" if i % 3 else f"s{i % 7}"
        rows.append((i, text(i // 2 if i % 4 < 2 else i, 20 + i % 50), "en", source, 0))
    long = text(5, 9000)
    rows += [(200, None, "en", "s1", 0), (201, "", None, None, 0), (202, " \n\t ", "de", None, 0),
             (203, "¿?!", "es", "s2", 0), (204, long, "en", "s3", 0), (205, long + " end", "en", "s3", 0),
             (206, " ".join(rows[3][1].split()[:-1]), "en", "hot", 0),
             (207, rows[4][1].upper(), "en", "hot", 0), (208, rows[5][1].replace(" ", "\n"), "en", "a", 0),
             (209, "a\x0bb\x0cc", "en", "é", 0), (210, "abc", "en", "Z", 0), (211, "ab c", "en", "z", 0),
             (212, "one  two \n\n three\xa0 four", "en", "s1", 0), (-5, "ab c", "en", "s1", 0)]
    return spark.createDataFrame(rows, DOCUMENTS)


@pytest.fixture(scope="session")
def odd(documents):
    """The same with a null id, repeated rows and columns whose names operators use."""
    rows = [(None, "abc", None, None, 1), (210, "abc", "en", "Z", 0), (210, "abc", "en", "Z", 0),
            (None, None, None, None, None)]
    more = documents.sparkSession.createDataFrame(rows, DOCUMENTS)
    named = documents.union(more)
    for name in ("shard", "slot", "score", "size", "fp", "kept", "length", "target", "before"):
        named = named.withColumn(name, named["n_chars"] + 1)
    return named
