import random

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double, "
          "ids string, id long, mark long, cls long, once int, nth int, keep_id int, found int, route long")


def _vocabulary(r):
    return ["".join(r.choice("abcdefghilmnorstu") for _ in range(r.randint(2, 8))) for _ in range(400)]


def make_rows(seed=1):
    """(doc_id, text): usual texts, copies, near copies, shared passages, and odd rows."""
    r = random.Random(seed)
    v = _vocabulary(r)
    line = lambda n: " ".join(r.choice(v) for _ in range(n))
    passage = line(60)
    base = line(120).split()
    rows = [(i, line(r.randint(60, 200)) + ".\n" + line(30)) for i in range(10, 40)]
    rows += [(100 + i, passage + "\n" + line(r.randint(20, 120))) for i in range(8)]
    for i in range(14):                       # near copies, some linked, some not
        w = list(base)
        for _ in range(i // 2):
            w[r.randrange(len(w))] = r.choice(v)
        rows.append((200 + i, " ".join(w)))
    rows += [(300 + i, rows[3][1]) for i in range(5)]          # exact copies
    rows += [(20, rows[10][1]), (21, "another text of the same id " + line(70))]   # repeated row and id
    rows += [(400, None), (401, ""), (402, " \n\t "), (None, line(80)), (None, rows[3][1]), (None, None),
             (403, "one"), (404, "One two"), (405, "one two three"), (406, "word " * 300), (407, line(9000)),
             (408, "x" * 40000), (409, "éè ü ñ 中文 \U0001f600 " * 20), (410, "a b c d"), (411, "A B c d")]
    r.shuffle(rows)
    return rows


def frame(spark, rows):
    """A frame like documents, with columns whose names clash with what operators use."""
    full = [(d, t, "en", None if i % 9 == 0 else f"s{i % 4}", None if t is None else len(t), i % 2 == 0, 0.5, "x", i, i, i, i, i, i, i, i)
            for i, (d, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(4)


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark, rows):
    ids = sorted({d for d, _ in rows if d is not None})
    data = [(d, 1 if d < 400 else 0, 1 if d % 7 == 0 else 0) for d in ids] + [(None, 1, 1), (10, None, None), (9999, 1, 1)]
    return spark.createDataFrame(data, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


def multiset(df, *cols):
    return sorted((tuple(x) for x in df.select(*cols).collect()), key=repr)
