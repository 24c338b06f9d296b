"""Small document and vector tables with every odd case."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, id long, component string, gone int"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def texts(seed=0, long_words=4000):
    rng = random.Random(seed)
    base = [words(rng, rng.randint(30, 120)) for _ in range(14)]
    passage = words(rng, 70)
    out = list(base)
    out += [base[0], base[0], base[1]]  # copies
    near = base[2].split(" ")
    near[5] = "changed"
    out += [" ".join(near), base[2].upper()]
    out += [words(rng, 20) + " " + passage + " " + words(rng, 20) for _ in range(4)]  # a passage within lines
    out += ["\n".join([base[3], "A common line of text, 12.", words(rng, 25)]), "\n".join(["a COMMON line of text 99", words(rng, 30)])]
    out += ["", " ", "\n\n", "one", "two words", "three word text", "x" * 1500, "é ü ñ " * 40, "日本語のテキスト " * 30, "tab\tand  blanks \n end "]
    out += [words(rng, long_words)]
    return out


def rows(extra=True, seed=0):
    got = [(i, t, "en" if i % 2 else None, None if i % 5 == 0 else f"s{i % 3}", len(t), "k", i, "c", 1) for i, t in enumerate(texts(seed))]
    if extra:
        n = len(got)
        got += [(n, None, None, None, None, None, None, None, None), (None, "a text without an id, of several words here", "en", "s", 5, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
        got += [got[4], got[4]]  # repeated rows
        got += [(7, "another text under an id that is taken already by one", "en", "s", 3, "k", 1, "c", 2)]
    return got


def documents(spark, extra=True, seed=0):
    return spark.createDataFrame(rows(extra, seed), DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)
