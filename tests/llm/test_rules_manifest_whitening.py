"""Repetition rules, the Merkle manifest and whitening against brute force, with odd rows of every kind."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from panelkit.llm import merkle_manifest, repetition_rules, whitening

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, runs string, part int, Tree int"
LINE = "one line that comes again and again in this text"
WORDS = np.random.default_rng(4).integers(0, 400, 4000)
CLEAN = " ".join(f"w{w}" for w in WORDS)
TEXTS = [None, "", "\n", " \t\n a", LINE, "\n".join([LINE] * 3), CLEAN, CLEAN + "\n" + CLEAN, CLEAN + "\n" + " ".join(f"v{w}" for w in WORDS[:200]) + "\n" + CLEAN[:400],
         "é€😀 " * 30, "a#b $$ | <x> & %*", ("x" * 70_000 + " ") * 40, "\r\n".join(["a b c d e f g"] * 9) + CLEAN[:3000], "A B\nA B\nÀ B"]


def rows():
    out = [(i, t, "en" if i % 3 else None, None if i % 4 == 0 else f"s{i % 2}", None if t is None else len(t), 1, "r", 2, 3) for i, t in enumerate(TEXTS)]
    out += [out[6], out[6], (6, "other text", None, "s0", 3, 1, "r", 2, 3), (None, CLEAN, "de", "s1", None, 1, "r", 2, 3), (None, None, None, None, None, 1, "r", 2, 3),
            (-7, "ABC abc ÄÖ", "de", "", 10, 1, "r", 2, 3), (90, "ABC", "de", "lonely", 10, 1, "r", 2, 3)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def rules(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)

    def covered(n):
        count = collections.Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
        mark = bytearray(len(words))
        for i in range(len(words) - n + 1):
            if count[tuple(words[i:i + n])] > 1:
                mark[i:i + n] = b"\1" * n
        return mark

    chars, symbols = sum(map(len, words)), sum(c in "#*$%&|<>" for c in text)
    seen, lines, line_chars = set(), 0, 0
    for line in text.split("\n"):
        own = re.findall("[^\x20\x09-\x0D]+", line)
        if own and line in seen:
            lines, line_chars = lines + 1, line_chars + sum(map(len, own))
        seen.add(line)
    grams = [sum(len(w) for w, c in zip(words, covered(n)) if c) for n in repetition_rules.NGRAM_LIMITS]
    failed = len(words) < 50 or 100 * sum(covered(3)) > 50 * len(words)
    kept = not failed and 100 * line_chars <= repetition_rules.LINE_LIMIT * chars and all(100 * g <= m * chars for g, m in zip(grams, repetition_rules.NGRAM_LIMITS.values()))
    return (len(words), chars, symbols, lines, sum(covered(3)), line_chars, grams, failed, kept)


def test_rules_equal_brute_force(docs):
    got = sorted(repr(tuple(r)) for r in repetition_rules.judge(docs).collect())
    assert got == sorted(repr((r[0], *rules(r[1]))) for r in rows())
    assert repetition_rules.judge(docs.limit(0)).collect() == []
    by_id = {r.doc_id: r for r in repetition_rules.judge(docs).collect()}
    assert by_id[8].kept and not by_id[7].kept and by_id[7].base_failed


def test_rules_of_random_texts_in_one_slice():
    random = np.random.default_rng(2)
    texts = ["".join(random.choice(list("ab \n\r\té#"), int(random.integers(150)))) for _ in range(600)]
    m = repetition_rules.measure(pa.array(texts))
    got = list(zip(m.n_words.tolist(), m.word_chars.tolist(), m.n_symbols.tolist(), m.n_dup_lines.tolist(), m.n_repeat_words.tolist(), m.line_chars.tolist(), m.gram_chars.T.tolist()))
    assert [tuple(map(repr, g)) for g in got] == [tuple(map(repr, rules(t)[:7])) for t in texts]


def test_clashing_hashes_are_told_apart():
    numbers, owner = np.array([1, 2, 3, 1, 2, 4, 1, 2]), np.array([0, 0, 0, 0, 0, 0, 1, 1])
    at = np.array([0, 1, 2, 3, 4, 6])
    assert repetition_rules._repeated(at, np.zeros(6, np.uint64), numbers, owner, 2).tolist() == [0, 3]


def test_rules_judge_the_verdict_by_its_limits(spark):
    """A text whose repeats pass the base rules: the coverage limits alone decide."""
    words = [f"a{i}" for i in range(300)]
    text = " ".join([*words, *words[:100]])  # 200 of 400 words stand in repeats
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    judged = [repetition_rules.judge(frame, {10: limit}).first() for limit in (40, 60)]
    assert [r.kept for r in judged] == [False, True] and not judged[0].base_failed


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    doc, text, lang, source, n = row[:5]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def way(levels, at):
    out = []
    for level in levels[:-1]:
        first = at // 16 * 16
        out.append((level[first:at], level[at + 1:first + 16]))
        at //= 16
    return out


def fold(digest, steps):
    for left, right in steps:
        digest = h(*left, digest, *right)
    return digest


def manifest(table):
    by_source = collections.defaultdict(list)
    for r in table:
        by_source[r[3]].append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        by_source[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = [tree([leaf(r) for r in by_source[s]]) for s in order]
    top = tree([t[-1][0] for t in trees])
    root, out = top[-1][0], []
    for g, s in enumerate(order):
        for at, r in enumerate(by_source[s]):
            steps = way(trees[g], at) + way(top, g)
            found = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None:
                found = (r[0], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]), *r[2:])
            folded = fold(leaf(found), steps)
            out.append((r[0], leaf(r), trees[g][-1][0], root, h(*(x for left, right in steps for x in (*left, *right))), folded, folded == root))
    return out


@pytest.mark.parametrize("slice_rows", [1 << 14, 37, 1])
def test_manifest_equals_brute_force(spark, monkeypatch, slice_rows):
    """Whatever the slices: one for each range, some within a run, one for each leaf."""
    monkeypatch.setattr(merkle_manifest, "SLICE", slice_rows)
    many = rows()
    if slice_rows > 1:
        many += [(1000 + i, f"Text {i}", "en", f"t{i % 29}" if i % 3 else "hot", i, 1, "r", 2, 3) for i in range(1200)]
    frame = spark.createDataFrame(many, SCHEMA).repartition(5)
    got = [tuple(r) for r in merkle_manifest.prove(frame).drop("place", "n_leaves").collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, manifest(many)))
    if slice_rows > 1:
        assert {r[6] for r in got} == {True, False}


def test_manifest_of_few_rows(spark):
    for many in ([(5, "ONE", "en", None, 3, 1, "r", 2, 3)], [(5, "ONE", "en", None, 3, 1, "r", 2, 3)] * 18, []):
        got = [tuple(r) for r in merkle_manifest.prove(spark.createDataFrame(many, SCHEMA)).drop("place", "n_leaves").collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, manifest(many) if many else []))
    assert all(r.verified for r in merkle_manifest.prove(spark.createDataFrame(rows(), SCHEMA), tampered=False).collect())


def test_missing_is_minimal():
    for n in (1, 2, 16, 17, 300, 5000):
        for low, high in ((0, 1), (0, n), (n - 1, n), (n // 3, n // 2 + 1)):
            known, wanted, width = set(range(low, high)), set(), n
            for depth in range(len(merkle_manifest.widths(n)) - 1):
                children = {c for i in known for c in range(i // 16 * 16, min(width, i // 16 * 16 + 16))}
                wanted |= {(depth, c) for c in children - known}
                known, width = {i // 16 for i in known}, -(-width // 16)
            assert set(merkle_manifest.missing(low, high, n)) == wanted
            assert len(list(merkle_manifest.missing(low, high, n))) == len(wanted)


VECTORS = np.random.default_rng(8).normal(size=(300, 12)).astype(np.float32) * np.linspace(2, 0.2, 12, dtype=np.float32)


def whitened(vectors, k=4):
    """n, deviations, whitened columns and explained shares by numpy's solver."""
    x = np.floor(np.array(vectors, np.float64) * 256).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    v = centred.T @ centred / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    return n, ((n * x - s) ** 2).sum(axis=1), (x - s / n) @ axes / np.sqrt(values), values / np.trace(v)


def test_whitening_equals_numpy(spark):
    usable = [(i, [float(c) for c in v], 1, 2) for i, v in enumerate(VECTORS)]
    usable += [usable[3], (400, usable[5][1], 1, 2), (None, usable[7][1], 1, 2)]
    odd = [(500, None, 1, 2), (501, [], 1, 2), (502, [float("nan")] + [1.0] * 11, 1, 2), (503, [None] + [1.0] * 11, 1, 2), (504, [float("-inf")] * 12, 1, 2), (505, [1.0, 2.0], 1, 2)]
    frame = spark.createDataFrame(usable + odd, "vec_id long, embedding array<float>, X int, component int").repartition(3)
    n, deviation, white, explained = whitened([r[1] for r in usable])
    got = whitening.whiten(frame).collect()
    assert len(got) == 4 * len(usable) and n == 300
    by_key = {}
    for r in got:
        by_key.setdefault((r.vec_id, r.component), []).append(r)
    sign = {k: np.sign(by_key[0, k][0].whitened * white[0, k - 1]) for k in range(1, 5)}
    for at, u in enumerate(usable):
        for k in range(1, 5):
            r = by_key[u[0], k][0]
            assert (r.n, r.deviation) == (n, deviation[at])
            assert abs(r.whitened * sign[k] - white[at, k - 1]) < 1e-10 and abs(r.explained - explained[k - 1]) < 1e-12 and r.identity_error < 1e-9
    assert whitening.whiten(frame.limit(0)).collect() == []


def test_whitening_of_flat_data(spark):
    """No component without an eigenvalue; huge entries saturate and deviations beyond a long are null."""
    kinds = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25])] * 5, kinds)).collect() == []
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(9)], kinds)).collect()
    assert {r.component for r in line} == {1} and len(line) == 9 and abs(line[0].explained - 1) < 1e-12
    huge = whitening.whiten(spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [5.0, 3.0])], kinds)).collect()
    assert {r.deviation for r in huge if r.vec_id != 3} == {None} and all(np.isfinite(r.whitened) for r in huge)


@pytest.mark.parametrize("values", [[5, 5, 5, 5, 1, 1, 0, 0], [3, 3 - 1e-12, 3 - 1e-8, 2, 1, 0, 0, 0], [1, 0, 0, 0, 0, 0, 0, 0], [9, 4, 1, 1, 1, 1, 1, 1], [2] * 8])
def test_eigenvectors_of_clusters(values):
    q, _ = np.linalg.qr(np.random.default_rng(len(set(values))).normal(size=(8, 8)))
    v = q @ np.diag(np.array(values, float)) @ q.T
    v = (v + v.T) / 2
    e, rows_of = whitening.components(v, 4)
    assert np.abs(e - np.sort(values)[::-1][:4]).max() < 1e-13 * 10
    assert np.abs(v @ rows_of.T - rows_of.T * e).max() < 1e-13 * 10 and np.abs(rows_of @ rows_of.T - np.eye(4)).max() < 1e-13


@pytest.mark.parametrize("size", [1, 2, 3, 30])
def test_sturm_counts_and_reflections(size):
    a = np.random.default_rng(size).normal(size=(size, size))
    a = a + a.T
    diagonal, off, _ = whitening.tridiagonal(a)
    values = np.linalg.eigvalsh(a)
    t = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
    assert np.abs(np.linalg.eigvalsh(t) - values).max() < 1e-12 * size
    shifts = np.concatenate((values - 1e-9, values + 1e-9))
    assert whitening.below(diagonal, off, shifts).tolist() == [int((values < s).sum()) for s in shifts]
