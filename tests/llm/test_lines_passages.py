import itertools
import random
import re

import numpy as np
import pyarrow as pa

from tessera.llm import lines, passages
from tests.llm.data import documents, empty, rows


def slow_edits(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        row, old = [i], row
        for j, d in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (c != d)))
    return row[-1]


def test_edits():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ("".join(rng.choice("ab ") for _ in range(rng.randint(0, 30))) for _ in "xy")
        assert lines.edits(a, b) == slow_edits(a, b)


def test_similar_equals_edits(spark, monkeypatch):
    """Pairs that share a beginning, an end, both or all of the shorter one."""
    rng = random.Random(14)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(1, 4)))
    pairs = []
    for i in range(400):
        x = [word() for _ in range(rng.randint(1, 24))]
        y = list(x)
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(y) + 1)
            y[k : k + rng.randint(0, 2)] = [word() for _ in range(rng.randint(0, 2))]
        pairs.append((i, " ".join(x), " ".join(y) or "a"))
    pairs += [(900, "a b", "a b c"), (901, "a", "a a"), (902, "a b a b", "a b"), (903, "x y z", "x y z")]
    frame = spark.createDataFrame(pairs, "i long, l_line string, r_line string")
    monkeypatch.setattr(lines, "SHARED", 0.0)
    want = {i for i, x, y in pairs if slow_edits(x, y) <= int(0.2 * max(len(x), len(y)) + 1e-9)}
    assert {r.i for r in lines._similar(frame, 0.8).collect()} == want
    assert {i for i, x, y in pairs if lines.alike(x, y, 0.8)} == want


def plain(line):
    return [w for w in map(lines.normal_word, line.split()) if w]


def brute_lines(data):
    """What goes by edit similarity alone: no sign of a sketch decides."""
    spots = {}
    for r in data:
        if r[0] is not None and r[1] is not None:
            for k, line in enumerate(r[1].split("\n")):
                if len(line.split()) >= 3 and len(plain(line)) >= 3:
                    spots.setdefault(" ".join(plain(line)), set()).add((r[0], k))
    group = {k: k for k in spots}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in itertools.combinations(spots, 2):
        if lines.edits(a, b) <= 0.2 * max(len(a), len(b)):
            group[find(a)] = find(b)
    first = {}
    for k in spots:
        first[find(k)] = min(first.get(find(k), (10**9, 0)), min(spots[k]))
    return {spot for k in spots for spot in spots[k] if spot != first[find(k)]}


def test_lines_equal_brute_force(spark):
    data = rows()
    rng = random.Random(3)
    long = " ".join(f"word{rng.randrange(500)}" for _ in range(400))
    data += [(200, long, "en", "s", 1, "k", 1, "c", 1), (201, long.replace("word7 ", "word7x ") + " end", "en", "s", 1, "k", 1, "c", 1), (202, "head line of this\n" + long.upper() + "!", "en", "s", 1, "k", 1, "c", 1)]
    out = lines.dedup_lines(spark.createDataFrame(data, documents(spark).schema)).collect()
    assert len(out) == len(data)
    gone = {(r.doc_id, k) for r in out if r.removed_lines for k in r.removed_lines}
    assert gone == brute_lines(data)
    for r in out:
        if r.removed_lines is not None:
            source = next(x for x in data if x[0] == r.doc_id and x[1] is not None)
            if source[0] != 7:
                assert r.text == "\n".join(t for k, t in enumerate(source[1].split("\n")) if k not in r.removed_lines)
                assert r.n_chars == len(r.text)
        else:
            assert (r.doc_id, r.text) in {(x[0], x[1]) for x in data}


def changed(rng, line, kind):
    """``line`` with words replaced, put in or left out, up to an edit similarity of 0.8."""
    words = line.split()
    while True:
        one = list(words)
        for _ in range(rng.randint(1, max(1, len(words) // 5))):
            i = rng.randrange(len(one))
            if kind == 0:
                one[i] = "".join(rng.choice("klmnopq") for _ in range(rng.randint(2, 8)))
            elif kind == 1:
                one.insert(i, "".join(rng.choice("klmnopq") for _ in range(rng.randint(2, 8))))
            elif len(one) > 4:
                del one[i]
        other = " ".join(one)
        if other != line and lines.edits(line, other) <= 0.2 * max(len(line), len(other)):
            return other


def test_lines_recall(spark):
    """Lines of 5 to 60 words, some of them common, and one of an edit similarity of 0.8 or more to each."""
    rng = random.Random(11)
    common = ["the", "of", "and", "to", "in", "is", "that"]
    data = []
    for i in range(600):
        n = rng.randint(5, 60)
        line = " ".join(rng.choice(common) if rng.random() < 0.3 else "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 9))) for _ in range(n))
        data += [(2 * i, line), (2 * i + 1, changed(rng, line, i % 3))]
    out = {r.doc_id: r for r in lines.dedup_lines(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert sum(bool(out[2 * i + 1].removed_lines) for i in range(600)) >= 588
    assert not any(out[2 * i].removed_lines for i in range(600))


def test_normalised_lines(spark):
    """Case, digits, signs and letters beyond ASCII: equal lines are those that plain Python normalises alike."""
    rng = random.Random(6)
    letters = ["a", "B", "7", "é", "É", "ß", "漢", "-", "'", "·", "K", "k", "İ", "x\u0301", "Ж", "ж", " ", " ", " ", "\t", "\r", "\x0b"]
    data = [(i, "\n".join("".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(0, 5)))) for i in range(300)]
    data += [(1000 + i, t.upper() if i % 2 else t.replace(" ", " - ")) for i, t in data[:100]]
    batch = pa.RecordBatch.from_arrays([pa.array([d for d, _ in data]), pa.array([t for _, t in data])], ["doc_id", "text"])
    got = lines._split(batch, 3)
    want, words = [], {}
    for d, t in data:
        for k, line in enumerate(t.split("\n")):
            raw = [w for w in re.split("[ \t\n\r\x0b\x0c]+", line) if w]
            ws = [p for p in map(lines.normal_word, raw) if p]
            if len(raw) >= 3 and len(ws) >= 3:
                want.append((d, k, len(" ".join(ws)), ws))
    ids, units, numbers, starts, chars = got
    assert list(zip(ids.tolist(), units.tolist(), chars.tolist(), strict=True)) == [w[:3] for w in want]
    flat = [w for x in want for w in x[3]]
    assert len(flat) == len(numbers)
    for w, n in zip(flat, numbers.tolist(), strict=True):
        assert words.setdefault(w, n) == n
    assert len(set(words.values())) == len(words)


def test_columns_keep_their_names(spark):
    names = ["_found", "_gone", "_doc", "_text", "_got", "_c", "_GONE_"]
    docs = spark.createDataFrame([(i, "one line that is there twice\nsome line", *names) for i in (1, 2)], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    for out in (lines.dedup_lines(docs), passages.dedup_passages(docs)):
        assert all([r[n] for n in names] == names for r in out.collect())
        assert out.columns[: len(docs.columns)] == docs.columns


def test_lines_empty(spark):
    assert lines.dedup_lines(empty(spark)).count() == 0


def test_passages(spark):
    data = rows(extra=False)
    docs = documents(spark, extra=False)
    out = {r.doc_id: r for r in passages.dedup_passages(docs).collect()}
    assert len(out) == len(data)
    # Of the four texts around one passage the first keeps it, the others lose most of it.
    shared = [i for i in range(19, 23)]
    assert out[shared[0]].removed is None
    for i in shared[1:]:
        assert out[i].removed and len(data[i][1]) - len(out[i].text) > 200
    # Copies lose all but what is too short; a text of its own loses nothing.
    assert out[14].removed and len(out[14].text.split()) < 16
    assert out[5].removed is None and out[5].text == data[5][1]


def test_passage_recall(spark):
    """Paragraphs of a similarity of 0.8 or more, by brute force, against those that the bands link."""
    rng = random.Random(9)
    data, pairs = [], []
    for i in range(300):
        a = [f"w{rng.randrange(10**6)}" for _ in range(24)]
        b = list(a)
        if i % 2:
            b[0] = "changed"
        data += [(2 * i, " ".join(a)), (2 * i + 1, " ".join(b))]
    out = {r.doc_id: r for r in passages.dedup_passages(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    found = sum(bool(out[2 * i + 1].removed) for i in range(300))
    assert found >= 294
    assert not any(out[2 * i].removed for i in range(300))
    assert passages.tune() == (7, 3)


def test_long_line_recall(spark):
    """Lines of 25 to 200 words and one of a similarity of 0.8 or more to each, by brute force, go as a whole."""
    rng = random.Random(10)
    data = []
    while len(data) < 600:
        a = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(25, 200))]
        b = list(a)
        for _ in range(rng.randint(1, max(1, len(a) // 40))):
            b[rng.randrange(len(b))] = f"w{rng.randrange(10**6)}"
        s, t = ({tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in (a, b))
        if len(s & t) >= 0.8 * len(s | t):
            data += [(len(data), " ".join(a)), (len(data) + 1, " ".join(b))]
    out = {r.doc_id: r for r in passages.dedup_passages(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert sum(not out[i].text.split() for i in range(1, 600, 2)) >= 294
    assert all(out[i].text == data[i][1] for i in range(0, 600, 2))


def test_passage_of_a_removed_line_stays_elsewhere(spark):
    """A paragraph whose first occurrence goes with its whole line is kept at the next one."""
    rng = random.Random(12)
    # A copy that is equal to the line that goes, but not to the one that stays, where a word was changed.
    a = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    b = list(a)
    b[60] = "changed"
    c = [f"w{rng.randrange(10**6)}" for _ in range(100)] + b[50:72] + [f"w{rng.randrange(10**6)}" for _ in range(100)]
    data = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(c))]
    out = {r.doc_id: r.text for r in passages.dedup_passages(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert out[1] == data[0][1] and not out[2].split() and "changed" in out[3].split()


def test_passages_odd_rows(spark):
    assert passages.dedup_passages(documents(spark)).count() == len(rows())
    assert passages.dedup_passages(empty(spark)).count() == 0


def test_common_words_are_counted_on_all_lines(spark):
    """Beyond any number of documents, and of common words, that a sample or a list would end at."""
    n, some = 45_000, 22_000
    words = lambda i: f"every {'even' if i % 2 else 'odd'}{chr(97 + i % 3)} w{''.join(chr(97 + int(c)) for c in str(i % some))}x"
    frame = spark.createDataFrame([(i, words(i) if i % 9 else f"{words(i)} {words(i)}\n{words(i)}") for i in range(n)], "doc_id long, text string")
    counts, total = {}, 0
    for i in range(n):
        times = 1 if i % 9 else 2
        total += times
        for w in words(i).split():
            counts[w] = counts.get(w, 0) + times
    rare, lines.RARE = lines.RARE, 1.5 / total
    try:
        hashes, weights = lines._common(frame, 3)
        want = sorted((lines.RARE / (c / total)) ** lines.POWER for c in counts.values() if c > lines.RARE * total)
    finally:
        lines.RARE = rare
    assert len(want) > 20_000 and len(hashes) == len(want) and (hashes[1:] > hashes[:-1]).all()
    assert max(abs(a - b) for a, b in zip(sorted(weights), want, strict=True)) < 1e-12


def test_words_beyond_ascii_are_hashed_together(monkeypatch):
    """Words with letters beyond ASCII hash as their normalised letters do, by a few calls for all of a batch."""
    calls, plain = [], lines.word_hashes
    monkeypatch.setattr(lines, "word_hashes", lambda *a: calls.append(1) or plain(*a))
    words = [f"É{k}x\u00fc" for k in range(3000)] + ["ΑΣ", "αΣ", "… —", "٣٤", "é" * 150, "İI", "ẞß"]
    text = "\n".join([" ".join(words), "a b É1X\u00fc", "c d é2x\u00fc "])
    _, _, numbers, starts, chars = lines._split(pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], ["id", "text"]), 3)
    assert len(calls) < 5
    want = []
    for line in text.split("\n"):
        normal = [w for w in map(lines.normal_word, line.split(" ")) if w]
        data = [np.frombuffer(w.encode(), np.uint8) for w in normal]
        want.append(([int(plain(d, np.zeros(1, np.int64), len(d))[0][0]) for d in data], len(" ".join(normal))))
    assert [x.tolist() for x in np.split(numbers, starts[1:])] == [w for w, _ in want]
    assert chars.tolist() == [n for _, n in want]


def test_edits_side_by_side(monkeypatch):
    """Many pairs at once, of any length and shape, get the answers of the slow count; few are counted one by one."""
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abc é日") for _ in range(n))
    pairs = [(x := text(rng.randint(0, 150)), x[: rng.randint(0, 150)] + text(rng.randint(0, 9)) + x[rng.randint(0, 150) :]) for _ in range(150)]
    pairs += [(text(n), text(n + d)) for n in (1, 63, 64, 65, 128, 129) for d in (-1, 0, 1) if n + d]
    far = [(a, b, slow_edits(a, b)) for a, b in pairs]
    one, calls = lines.edits, []
    monkeypatch.setattr(lines, "PAIRS", 1)
    monkeypatch.setattr(lines, "edits", lambda *a: calls.append(1) or one(*a))
    assert lines.within([(a, b, d) for a, b, d in far]).all()
    assert not lines.within([(a, b, d - 1) for a, b, d in far]).any()
    assert len(calls) < len(pairs) / 4


def test_wide_words_are_normalised_together(monkeypatch):
    """No word beyond ASCII is looked at by itself: what a batch costs follows its letters, not its distinct words."""
    calls, plain = [], lines.normal_word
    words = [f"Ж{k}\u0130\u03a3" for k in range(500)] + ["\u03a3\u03a3", "\u00b2\u0664\x00\u4e00", "\u2026\u2014"]
    want = [lines.word_hashes(d := np.frombuffer(p.encode(), np.uint8), np.zeros(1, np.int64), len(d))[0][0] for p in map(plain, words) if p]
    monkeypatch.setattr(lines, "normal_word", lambda w: calls.append(1) or plain(w))
    _, _, numbers, _, _ = lines._split(pa.RecordBatch.from_arrays([pa.array([1]), pa.array([" ".join(words)])], ["id", "text"]), 3)
    assert numbers.tolist() == want and not calls


def test_normal_line():
    rng = random.Random(9)
    letters = [*map(chr, range(140)), "é", "\u03a3", "\u0130", "\u0664", "\u2003", "\xa0", "  "]
    for size in (0, 3, 30):
        for _ in range(500):
            line = "".join(rng.choice(letters[: 128 if rng.random() < 0.5 else None]) for _ in range(size)).replace("\n", "")
            assert lines.normal_line(line) == " ".join(filter(None, map(lines.normal_word, lines._SPACES.split(line))))


def test_aligned_words_settle_long_lines(monkeypatch):
    """The edits of an alignment suffice, and long lines with some words changed need no counting."""
    rng = random.Random(8)
    counted = []
    within = lines.within
    monkeypatch.setattr(lines, "within", lambda pairs: counted.append(len(pairs)) or within(pairs))
    for k in range(300):
        a = [rng.choice(["the", "of", ""]) if rng.random() < 0.3 else f"w{rng.randrange(60)}" for _ in range(rng.randrange(1, 60))]
        b = [x for x in a for x in ([x], [x], [x], [], ["new", x], ["other"])[rng.randrange(6) if k % 3 else 0]]
        x, y = " ".join(a), " ".join(b)
        assert lines.edits(x, y) <= lines.at_most(x, y) <= max(len(x), len(y)) + 1
        assert lines.alike(x, y, 0.8) <= (lines.edits(x, y) <= int(0.2 * max(len(x), len(y)) + 1e-9))
    counted.clear()
    a = [f"word{i}" for i in range(300)]
    b = ["other" if i % 20 == 5 else x for i, x in enumerate(a)]
    assert lines.alike(" ".join(a), " ".join(b), 0.8) and counted == [0]
