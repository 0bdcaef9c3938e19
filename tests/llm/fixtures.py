"""Small tables with the awkward rows that every operator must take: nulls, empty and very long texts, ties, repeated
rows, and extra columns whose names clash with those that the operators use inside."""

import random

CLASHING = ("id string, block string, bucket string, hash string, size string, rep string, label string, score string, "
            "place string, digest string, kept string, run string, uid string, spans string, n string, mark string")


def words(rng, n, vocabulary=400):
    return " ".join(f"w{min(int(rng.expovariate(0.02)), vocabulary)}" for _ in range(n))


def texts(seed=5, n=60):
    """Texts with exact and near copies, shared passages, and the awkward ones."""
    rng = random.Random(seed)
    out = [words(rng, rng.randint(5, 160), 4000) for _ in range(n)]
    passage = words(rng, 130, 4000)
    for i in range(0, n, 9):
        out[i] = out[i] + " " + passage + " " + words(rng, 12, 4000)
    for i in range(1, n, 6):
        out.append(out[i])  # exact copy
        out.append(out[i].replace(" ", "  \n", 1))  # equal but for white space
        w = out[i].split(" ")
        w[len(w) // 2] = "changed"
        out.append(" ".join(w))  # near copy
    out += ["", " \t\n", "one", "one two three", "One Two THREE", "é ü ß 漢字 😀 <|endoftext|>", "a" * 3000, "x " * 2000,
            words(rng, 30_000, 9000)]
    return out


def documents(spark, rows=None):
    """The documents table over ``texts`` with a null text, a null id, a null source, and a row that stands twice."""
    if rows is None:
        t = texts()
        rows = [(i, x, "en", f"s{i % 4}", len(x)) for i, x in enumerate(t)]
        rows += [(1000, None, None, None, None), (None, t[3], "en", "s1", 3), (1001, t[4], "en", None, 4)]
        rows += [rows[7], rows[8], rows[8]]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    extra = [c.strip().split(" ")[0] for c in CLASHING.split(",")]
    return spark.createDataFrame([(*r, *["?"] * len(extra)) for r in rows], f"{schema}, {CLASHING}").repartition(5)
