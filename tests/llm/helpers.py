"""Frames with everything a crawl may hold."""

import random

from tests.conftest import SF_SMALL

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Columns with the names of the operators' own results.
CLASHES = ("kept", "n_words", "found", "host", "node", "key", "at", "label", "lost", "n_lines", "bands", "score", "bin", "spans")


def words(rng, n, letters="abcdefghij"):
    return [("".join(rng.choice(letters) for _ in range(rng.randint(2, 6)))) for _ in range(n)]


def crawl(seed=3):
    """(doc_id, text) rows: nulls, blanks, short, very long, equal, nearly equal, shared lines and passages."""
    rng = random.Random(seed)
    base = words(rng, 160)
    passage, line = " ".join(words(rng, 44)), "A line that MANY documents  share"
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "ONE"), (5, "two words"), (6, "É é É"), (7, "é É é")]
    rows += [(10, " ".join(base)), (11, " ".join(base).upper()), (12, "\n".join(base)), (13, " ".join(base))]
    for k in range(20, 40):  # near copies of different distance
        w = list(base)
        for i in rng.sample(range(len(w)), (k - 20) // 2):
            w[i] = "new%d" % rng.randint(0, 10**6)
        rows.append((k, " ".join(w)))
    for k in range(40, 50):
        own = words(rng, 30 + 5 * k)
        rows.append((k, " ".join(own[:20]) + "\n" + (line if k % 2 else "  " + line.lower() + "\x0b") + "\n"
                     + " ".join(own[20:]) + " " + passage + " tail" * (k % 3) + "\n\n" + line))
    rows.append((60, " ".join(words(rng, 30_000))))
    rows.append((61, "again and again " * 400))
    rows.append((62, "x" * 50_000))
    rows.append((63, "\n".join(["- nul \x00 sign", "日本語 テキスト 。", "🙂 😀" * 20] * 3)))
    rows += [rows[9], rows[9], rows[40]]  # repeated rows
    return rows


def frame(spark, rows, clashes=True):
    """A documents frame of (doc_id, text) rows, with extra columns of clashing names."""
    full = [(i, t, "en" if i is None or i % 3 else None, None if i is None or i % 5 == 0 else f"src{i % 4}",
             None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(full, DOCS)
    return df.selectExpr("*", *[f"'x' AS {c}" for c in CLASHES]) if clashes else df


def same(got, want):
    """Equal as multisets of rows."""
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, want), key=key)


def stored(spark, path, rows, **more):
    """A folder of tables like the given ones, with these documents."""
    frame(spark, rows).write.mode("overwrite").parquet(f"{path}/documents.parquet")
    for name in ("benchmark", "labels", "pages"):
        spark.read.parquet(more.get(name) or f"{SF_SMALL}/{name}.parquet").write.mode("overwrite").parquet(f"{path}/{name}.parquet")
    return str(path)
