"""Small fixtures with nulls, empty and long texts, ties, repeated rows, clashing extra columns and empty tables."""

import hashlib
import re
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash

import corpus_pipeline
from panelkit.llm import (bwt_dedup, byte_bpe, chat_format, cotrain_quality, cross_polytope, phrase_print, simhash_dedup, soft_mixing,
                          substrings, superkmer_dedup, token_store)
from panelkit.llm.common import shared_path
from panelkit.session import ensure_checkpoint_dir

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, spans string, __id long, pos int"
PASSAGE = " ".join(f"word{i}" for i in range(70))
LONG = " ".join(f"w{i * i % 977}" for i in range(9000))
TEXTS = [(3, PASSAGE + " tail three"), (1, "head one " + PASSAGE), (2, None), (4, ""), (5, "  \n\t "), (6, "don't we'll  go\n\n x's 'tis 12 §é中😀"),
         (6, "don't we'll  go\n\n x's 'tis 12 §é中😀"), (None, PASSAGE), (7, LONG), (8, LONG), (9, PASSAGE + " " + PASSAGE), (-4, "a b"), (10, "one"),
         (11, "x" * 3000), (12, "ab " * 60)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", None, None if t is None else len(t), 7, "s", 1, 2) for i, t in TEXTS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (3, 1, 0), (7, 1, 0), (8, 0, 0), (9, 0, 1), (9, None, 1), (None, 1, 0), (12, 0, 0)], "doc_id long, quality int, toxic int")


def tokens(text):
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(RANKS), special_tokens={})
    return known.encode_ordinary(text or "")


def test_classes_equal_the_library():
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for pattern, kind in ((r"\p{L}", byte_bpe.LETTER), (r"\p{N}", byte_bpe.NUMBER), (r"\s", byte_bpe.SPACE)):
        of = tiktoken.Encoding("b", pat_str=pattern, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
        assert {ord(c) for c in bytes(of.encode_ordinary(every)).decode()} == set(np.flatnonzero(byte_bpe.code_classes() == kind).tolist())


def test_byte_bpe(docs, nothing):
    rows = byte_bpe.encode(docs, RANKS).collect()
    assert sorted((str(r.doc_id), r.ids) for r in rows) == sorted((str(i), tokens(t)) for i, t in TEXTS)
    text = TEXTS[5][1].encode()
    row = next(r for r in rows if r.doc_id == 6)
    assert byte_bpe.decode_span(np.array(row.ids), np.array(row.offsets), 4, 30, RANKS) == text[4:30]
    back = byte_bpe.decode(byte_bpe.encode(docs, RANKS), RANKS).collect()
    assert sorted((str(r.doc_id), bytes(r.bytes)) for r in back) == sorted((str(i), (t or "").encode()) for i, t in TEXTS)
    assert byte_bpe.encode(nothing, RANKS).collect() == []


def test_long_pieces_merge_alike():
    ranks = byte_bpe.load_ranks(RANKS)
    for piece in (b"abc" * 50, b"zq" * 30, "é".encode() * 40, b"the" * 15):
        assert byte_bpe.merge(piece, ranks) == tokens(piece.decode())


@pytest.mark.parametrize("bits", [1, 5, 8, 11, 16, 17, 31])
def test_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1000).astype(np.uint32)
    data = token_store.pack(ids, bits)
    assert len(data) == -(-1000 * bits // 8)
    assert (token_store.unpack(data, bits, 1000) == ids).all() and (token_store.unpack(data, bits, 300, 77) == ids[77:377]).all()


def test_token_store(spark, docs, nothing):
    path = shared_path(spark, "t")
    token_store.write(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    order = sorted(((i is not None, i or 0, len(tokens(t)), t or ""), tokens(t) + [0]) for i, t in TEXTS)
    rows = sorted(token_store.checksums(spark, path).collect(), key=lambda r: r.start)
    at = 0
    for (key, ids), r in zip(order, rows, strict=True):
        assert (r.doc_id, r.start, r.n_tokens) == (key[1] if key[0] else None, at, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    flat = [x for _, ids in order for x in ids]
    assert token_store.ids_at(spark, path, 5, 900).tolist() == flat[5:900]
    empty = shared_path(spark, "t")
    token_store.write(nothing, empty, public_tokenizers.path("byte_bpe_50k.json"))
    assert token_store.checksums(spark, empty).collect() == []


def test_phrase_print(docs, nothing, spark):
    rows = phrase_print.compare_spliced(docs).collect()
    assert len(rows) == len(TEXTS)
    order = sorted(TEXTS, key=lambda x: (x[0] is None, -(x[0] or 0), x[1] or ""))
    want = {}
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        want.setdefault(i, []).append(hashlib.sha256(phrase_print.splice(t or "", after or "").encode()).hexdigest())
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append(r.edited_sha256)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    by_text = {}
    for r in phrase_print.fingerprints(docs).collect():
        by_text.setdefault(r.n_chars if r.n_chars in (len(LONG), 0) else None, set()).add(r.fingerprint)
    assert len(by_text[len(LONG)]) == 1 and by_text[0] == {"0000" * phrase_print.SLOTS}
    assert phrase_print.compare_spliced(nothing).collect() == []
    alone = phrase_print.compare_spliced(spark.createDataFrame([(None, "abcd")], "doc_id long, text string")).collect()
    assert [(r.n_chars, r.near_next) for r in alone] == [(4, 1.0)]


def test_equal_substrings_share_phrases():
    rng = np.random.default_rng(1)
    shared = "".join(rng.choice(list("abcdefgh "), 4000))
    a, b = ("".join(rng.choice(list("abcdefgh "), n)) for n in (37, 501))
    one, two, other = phrase_print.prints([a + shared, b + shared, "".join(rng.choice(list("abcdefgh "), 4000))])
    assert phrase_print.likeness(one[None], two[None])[0] > 0.6
    assert phrase_print.likeness(one[None], other[None])[0] < 0.1


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(ids, prints, distance):
    label = list(range(len(ids)))
    for _ in ids:
        label = [min(label[j] for j in range(len(ids)) if (prints[i] ^ prints[j]).bit_count() <= distance) for i in range(len(ids))]
    return [min((ids[j] is not None, ids[j] or 0) for j in range(len(ids)) if label[j] == label[i]) for i in range(len(ids))]


def test_simhash(spark, docs, nothing):
    want = sorted((str(i), simhash(t), str(c[1] if c[0] else None)) for (i, t), c in zip(TEXTS, groups([i for i, _ in TEXTS], [simhash(t) for _, t in TEXTS], 3)))
    assert sorted((str(r.doc_id), r.fp % (1 << 64), str(r.component_id)) for r in simhash_dedup.cluster(docs).collect()) == want
    kept = simhash_dedup.deduplicate(docs)
    assert kept.columns == docs.columns and kept.count() == len({w[2] for w in want})
    assert simhash_dedup.cluster(nothing).collect() == [] and simhash_dedup.deduplicate(nothing).collect() == []


def test_no_partner_is_missed(spark):
    rng = np.random.default_rng(3)
    prints = set()
    for x in rng.integers(0, 1 << 63, 150).tolist():
        prints |= {x, *(x ^ sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for k in (1, 2, 3, 4))}
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    found = {(r.a, r.b) for r in simhash_dedup.link(spark.createDataFrame([(p,) for p in signed], "fp long"), 3, 4).collect()}
    assert found == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}


def key(i):
    return (i is not None, i or 0)


def test_phrase_print_holds_a_slice():
    import tracemalloc
    texts = [f"{i} " + "語" * 3000 for i in range(1500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    tracemalloc.start()
    assert all(row == (i, text) for i, (row, text) in enumerate(zip(phrase_print.rows_of([batch]), texts, strict=True)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 << 20  # all 1500 texts take 9 MB


def test_superkmers(docs, nothing):
    seen, want = {}, []
    for i, t in sorted(set(TEXTS), key=lambda x: key(x[0])):
        words = (t or "").encode().split()
        for p in range(len(words) - 19):
            seen.setdefault(tuple(words[p:p + 20]), (key(i), p))
    for i, t in TEXTS:
        words = (t or "").encode().split()
        gone = {q for p in range(len(words) - 19) if seen[tuple(words[p:p + 20])] != (key(i), p) for q in range(p, p + 20)}
        want.append((str(i), len(words), len(gone), b" ".join(w for q, w in enumerate(words) if q not in gone).decode()))
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in superkmer_dedup.remove(docs).collect()) == sorted(want)
    out = superkmer_dedup.deduplicate(docs)
    assert out.columns == docs.columns
    texts = {(str(r.doc_id), r.text) for r in out.collect()}
    assert texts == {(str(i), t if not w[2] else w[3]) for (i, t), w in zip(TEXTS, want)}
    assert superkmer_dedup.remove(nothing).collect() == []


def test_superkmers_cut_without_word_arrays(docs, capsys):
    """Texts that lose words are cut span by span, not by looking at every span for every word; other texts stay as they are."""
    superkmer_dedup.deduplicate(docs).explain("simple")
    plan = capsys.readouterr().out
    assert "lambdafunction" not in plan and "split(" not in plan and "ArrowEvalPython" in plan


def test_bwt_merge(docs, nothing):
    first, want = {}, []
    for i, t in sorted(TEXTS, key=lambda x: key(x[0])):
        b = (t or "").encode()
        for p in range(len(b) - 49):
            first.setdefault(b[p:p + 50], key(i))
    for i, t in TEXTS:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < key(i):
                gone[p:p + 50] = b"\1" * 50
        want.append((str(i), len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), bytes(c for c, g in zip(b, gone) if not g)))
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in bwt_dedup.remove(docs).collect()) == sorted(want)
    assert bwt_dedup.remove(nothing).collect() == []


def test_cross_polytope(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(400, 64))
    near = np.concatenate([base, base[:200] + rng.normal(size=(200, 64)) * 0.3, base[:100] + rng.normal(size=(100, 64)) * 0.25])
    rows = [(i, [float(np.float32(x)) for x in v], i % 3 if i % 50 else None) for i, v in enumerate(near)]
    rows += [(1000, rows[1][1], 1), (1001, rows[1][1], 1), (1002, None, 1), (1003, [0.0] * 64, 1), (1004, [float("nan")] + [1.0] * 63, 1),
             (1005, [None] + [1.0] * 63, 1), (1006, [], 1), (None, rows[4][1], 1), (1007, [1.0, 2.0], 1)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, node int")
    got = cross_polytope.near_duplicates(frame).collect()
    assert len(got) == len(rows)
    good = [v is not None and None not in v and len(v) == 64 and np.isfinite(v).all() and any(v) for _, v, _ in rows]
    x = np.array([v if g else [0.0] * 64 for (_, v, _), g in zip(rows, good)])
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    label = np.array([-1 if not g or r[2] is None else r[2] for r, g in zip(rows, good)])
    true = (x @ x.T >= 0.93) & (label[:, None] == label[None]) & (label >= 0)[:, None]
    np.fill_diagonal(true, False)
    links = {str(r[0]): int(n) for r, n in zip(rows, true.sum(axis=1))}
    assert all(r.n_links <= links[str(r.vec_id)] for r in got)
    assert sum(r.n_links for r in got) >= 0.99 * sum(links.values()) > 200
    by_id = {r.vec_id: r for r in got}
    assert by_id[1001].component_id == by_id[1].component_id == 1 and not by_id[1001].kept and by_id[1].kept
    assert all(by_id[i].n_links == 0 and by_id[i].kept for i in (1002, 1003, 1004, 1005, 1006, 0, 50))
    assert cross_polytope.near_duplicates(frame.limit(0)).collect() == []


def _linked_by_buckets(rows):
    """(links, least row of the component) of (vector, label) rows without copies: equal label and length, a probe that meets the other's own bucket, cosine."""
    n_links, least = [0] * len(rows), list(range(len(rows)))
    for label, width in {(c, len(v)) for v, c in rows}:
        at = [i for i, (v, c) in enumerate(rows) if (c, len(v)) == (label, width)]
        x = np.array([rows[i][0] for i in at])
        x = x / np.abs(x).max(axis=1, keepdims=True)
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        near = x @ x.T >= cross_polytope.COSINE
        keys = cross_polytope.buckets(x.astype(np.float32), cross_polytope.TABLES, cross_polytope.FUNCTIONS, cross_polytope.PROBES)
        own, probes = [set(k[:, 0].tolist()) for k in keys], [set(k.ravel().tolist()) for k in keys]
        for i, j in zip(*np.nonzero(np.triu(near, 1))):
            if own[i] & probes[j] or own[j] & probes[i]:
                n_links[at[i]] += 1
                n_links[at[j]] += 1
                a, b = least[at[i]], least[at[j]]
                least = [min(a, b) if x in (a, b) else x for x in least]
    return n_links, least


@pytest.mark.parametrize("slice_rows", [None, 7, 40])
def test_cross_polytope_in_slices(spark, monkeypatch, slice_rows):
    """Vectors of many slices, of labels that share one, of several lengths, single and double precision."""
    if slice_rows:
        monkeypatch.setattr(cross_polytope, "SLICE_ROWS", slice_rows)
    rng = np.random.default_rng(8)
    rows = []
    for label, width, n in ((1, 64, 150), (2, 64, 40), (1, 5, 20), (3, 64, 90), (9, 1, 2), *((100 + k, 16, 3) for k in range(5))):
        base = rng.normal(size=(-(-n // 3), width))
        vectors = np.repeat(base, 3, axis=0)[:n] + rng.normal(size=(n, width)) * np.repeat(rng.choice([0.05, 0.27], len(base)), 3)[:n, None]
        rows += [([float(x if i % 4 else np.float32(x)) for x in v], label) for i, v in enumerate(vectors)]
    n_links, least = _linked_by_buckets(rows)
    frame = spark.createDataFrame([(i, v, c) for i, (v, c) in enumerate(rows)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in cross_polytope.near_duplicates(frame).collect()}
    assert got == {i: (n, c) for i, (n, c) in enumerate(zip(n_links, least))} and sum(n_links) > 300


def test_cross_polytope_writes_no_pairs(spark):
    """400 near copies have 79,800 links; what is stored on the way grows with the vectors."""
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=64) + 0.02 * rng.normal(size=(400, 64))
    frame = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")
    at = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(at.iterdir()) if at.exists() else set()
    got = cross_polytope.near_duplicates(frame).collect()
    assert all((r.n_links, r.component_id) == (399, 0) for r in got) and len(got) == 400
    assert max(spark.read.parquet(str(p)).count() for p in set(at.iterdir()) - before) <= 400


def test_chat(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes <|im_end|>"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "assistant", "yes <|im_end|>"),
            (3, 1, "assistant", "yes <|im_end|>"), (4, 0, "user", "other"), (5, 0, None, None), (None, 0, "user", "lost"), (6, None, "user", "hi"), (6, 0, "assistant", "no")]
    frame = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, turns int")
    got = {r.conv_id: (r.n_turns, r.n_logs, r.chat) for r in chat_format.render(frame).collect()}
    assert sorted(got, key=str) == sorted([1, 4, 5, 6, None], key=str)
    assert got[1][:2] == (2, 2) and got[1][2].count("<|im_end|>") == 2 and got[5][2] == "<|im_start|>unknown\n<|im_end|>\n"
    assert chat_format.render(frame.limit(0)).collect() == []


def test_classifier_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    train = labels.where("pmod(xxhash64(doc_id, 1), 4) > 0")
    rows = cotrain_quality.score(docs, train).select("doc_id", "score").join(labels.where("pmod(xxhash64(doc_id, 1), 4) = 0"), "doc_id").collect()
    wanted = [r.score >= cotrain_quality.LIMIT for r in rows if r.quality == 1 and r.toxic == 0]
    low = [r.score >= cotrain_quality.LIMIT for r in rows if r.quality == 0]
    toxic = [r.score >= cotrain_quality.LIMIT for r in rows if r.toxic == 1]
    assert np.mean(wanted) > 0.97 and np.mean(low) < 0.1 and np.mean(toxic) < 0.35


def test_classifiers_on_odd_rows(docs, nothing, labels):
    assert cotrain_quality.score(docs, labels).count() == len(TEXTS)
    assert cotrain_quality.keep(docs, labels).columns == docs.columns
    assert cotrain_quality.keep(docs, labels.limit(0)).count() == len(TEXTS)
    assert cotrain_quality.keep(nothing, labels).collect() == [] and soft_mixing.mix(nothing, labels).collect() == []
    assert soft_mixing.mix(docs, labels).count() == len(TEXTS)
    assert soft_mixing.resample(docs, labels).columns == docs.columns


def test_rates_meet_the_targets(spark):
    out = soft_mixing.mix(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")).collect()
    p, w, r = np.array([x.p for x in out]), np.array([x.tokens for x in out], float), np.array([x.rate for x in out])
    assert (r >= 0).all() and np.abs((w * r) @ p / w.sum() - soft_mixing.TARGET).max() < 2e-3


def test_pipeline_stages(spark, docs, labels, tmp_path):
    for name, frame in (("documents", docs), ("labels", labels)):
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert rows and [f.name for f in spark.createDataFrame(rows).schema][:2] == ["doc_id", "ids"]
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    labels.write.parquet(f"{tmp_path}/none/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []


@pytest.mark.parametrize("hot_cores", [False, True])
@pytest.mark.parametrize("units_of,window,gram", [(substrings.byte_units, 50, 16), (substrings.word_units, 20, 8)])
def test_hot_minimisers_are_cut(units_of, window, gram, hot_cores):
    """Where every minimiser is hot, each window still travels once, and equal windows with equal keys."""
    words = np.random.default_rng(3).integers(0, 3, 900)
    texts = [" ".join("ab cde f".split()[w] for w in words[a:b]) for a, b in ((0, 400), (200, 700), (300, 420), (0, 5), (0, 0))]
    batch = pa.record_batch({"text": texts})
    every, none = np.full(1 << 10, 255, np.uint8), np.zeros(1 << 10, np.uint8)
    known = substrings.Known(substrings.Filter(1, every, every, every), substrings.Filter(1, every, every if hot_cores else none, none))
    at = {}
    for key, string, doc, pos, *_ in zip(*substrings._packed(batch, units_of, window, gram, known)):
        parts = string.split(b" ") if units_of is substrings.word_units else string
        for k in range(len(parts) - window + 1):
            at.setdefault((int(doc), int(pos) + k), []).append((int(key), tuple(parts[k:k + window])))
    want = {}
    for d, t in enumerate(texts):
        parts = t.encode().split() if units_of is substrings.word_units else t.encode()
        want |= {(d, k): tuple(parts[k:k + window]) for k in range(len(parts) - window + 1)}
    assert {k: v[0][1] for k, v in at.items()} == want and all(len(v) == 1 for v in at.values())
    keys = {}
    for [(key, content)] in at.values():
        keys.setdefault(content, set()).add(key)
    assert all(len(k) == 1 for k in keys.values())


def test_unclear_marks_are_sent_again(spark, docs, monkeypatch):
    """Counts that call every key's strings equal are put right by the buckets' own comparison."""
    want = sorted(map(str, superkmer_dedup.remove(docs).collect()))
    counted, noted = substrings.counted, []

    def blind(*args):
        out = counted(*args)
        return out._replace(varied=np.zeros_like(out.varied))

    note = substrings.Filter.note_varied
    monkeypatch.setattr(substrings, "counted", blind)
    monkeypatch.setattr(substrings.Filter, "note_varied", lambda self, hashes: (noted.append(len(hashes)), note(self, hashes))[1])
    assert sorted(map(str, superkmer_dedup.remove(docs).collect())) == want
    assert noted and min(noted) > 0


def test_token_store_equals_the_library(spark):
    """Added tokens in a text get their own ids, as the library gives them."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    special = [t.content for t in library.get_added_tokens_decoder().values()]
    random = np.random.default_rng(7)
    texts = ["", "plain text", *(f"a {s} b{s}" for s in special), *("".join(random.choice(list("ab <|>endoftx 1é\n'"), 80)) for _ in range(200)), special[0] * 3 if special else "x"]
    folder = shared_path(spark, "t")
    token_store.write(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), folder, path)
    got = {r.doc_id: r.ids for r in token_store.documents(spark, folder).collect()}
    assert got == {i: library.encode(t, add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}


def test_the_piece_cache_is_bounded_in_bytes():
    asked = []
    encoder = byte_bpe.PieceEncoder(lambda pieces: [asked.append(p) or [len(p)] for p in pieces], limit=2000)
    for _ in range(3):
        for k in range(40):
            assert [x.tolist() for x in encoder(["w" * (k + 1), "x" * 3000])] == [[k + 1], [3000]]
            assert sum(len(p) + len(x) + byte_bpe.ENTRY_BYTES for p, x in encoder.young.items()) == encoder.size <= 2000


def test_texts_longer_than_a_slice(spark, monkeypatch):
    """Whole texts count, whatever the slices: cut to a few bytes, the operators give the same rows."""
    random = np.random.default_rng(11)
    long = " ".join(f"w{x}" for x in random.integers(0, 900, 600))
    frame = spark.createDataFrame([(1, long), (2, "head " + long[:1500]), (3, None), (4, long[700:])], "doc_id long, text string").repartition(2)
    want = [sorted(map(str, op(frame).collect())) for op in (superkmer_dedup.remove, bwt_dedup.remove)]
    monkeypatch.setattr(substrings, "CHUNK_BYTES", 100)
    monkeypatch.setattr(substrings, "HELD_ROWS", 3)
    monkeypatch.setattr(substrings, "ANSWERED_ROWS", 2)
    assert [sorted(map(str, op(frame).collect())) for op in (superkmer_dedup.remove, bwt_dedup.remove)] == want


def scalar_print(text):
    """One text's sketch, one character and one name at a time."""
    full, seed, mult = (1 << 64) - 1, 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93

    def mix(x):
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & full
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & full
        return x ^ (x >> 31)

    def toss(own, other):
        low = ((own ^ other) & -(own ^ other)).bit_length() - 1
        return 2 * low + (own >> low & 1)

    names, best = [mix((ord(c) + seed) & full) for c in text], [None] * phrase_print.SLOTS
    for level in range(1, phrase_print.LAST_LEVEL + 1):
        collapsed = []
        for name in names:
            if collapsed and collapsed[-1][0] == name:
                collapsed[-1][1] += 1
            else:
                collapsed.append([name, 1])
        names = [name if n == 1 else mix(name ^ mix((n * seed) & full)) for name, n in collapsed]
        label = [toss(x, names[i - 1] if i else ~x & full) for i, x in enumerate(names)]
        for _ in range(3):
            label = [toss(x, label[i - 1] if i else x ^ 1) for i, x in enumerate(label)]
        for colour in (5, 4, 3):
            label = [next(c for c in range(3) if c not in (label[i - 1:i] + label[i + 1:i + 2])) if x == colour else x for i, x in enumerate(label)]
        phrases = []
        for i, name in enumerate(names):
            peak = i != 1 and (i == 0 or label[i] > label[i - 1]) and (i + 1 == len(names) or label[i] > label[i + 1])
            if peak or i == 0:
                phrases.append(mix((name + seed) & full))
            else:
                phrases[-1] = mix((phrases[-1] * mult + name) & full)
        names = phrases
        for name in names:
            key = mix(name ^ mult)
            if level in phrase_print.THINNED:
                if key % phrase_print.THINNED[level]:
                    continue
                key = mix(key)
            slot, rest = key >> 58, key & (1 << 58) - 1
            best[slot] = rest if best[slot] is None else min(best[slot], rest)
    return [0 if b is None else (b >> 8) % 65535 + 1 for b in best]


def test_prints_equal_a_scalar_version():
    random = np.random.default_rng(9)
    texts = ["a", "ab", "aa", "aaaa bbbb", "abc" * 50, "é中😀" * 9, PASSAGE, *("".join(random.choice(list("abcdefg hij\n"), int(random.integers(1, 700)))) for _ in range(60))]
    assert phrase_print.prints(texts).tolist() == [scalar_print(t) for t in texts]


def test_likeness_does_not_jump_with_length():
    """Texts that extend one another are about as alike on both sides of any length."""
    random = np.random.default_rng(12)

    def mean(a, b):
        long = ["".join(random.choice(list("abcdefghijklmnop "), b)) for _ in range(150)]
        return phrase_print.likeness(phrase_print.prints([t[:a] for t in long]), phrase_print.prints(long)).mean()

    for at in (100, 200, 400):
        assert mean(at - 1, at + 1) > mean(at + 1, at + 3) - 0.08 and mean(at - 1, at + 1) > 0.6


def test_rates_equal_a_scalar_version(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    members = soft_mixing.posteriors(docs, labels)
    rows = {r.doc_id: (r.tokens, r.p) for r in members.collect()}
    total = sum(w for w, _ in rows.values())
    target, k = (1.0, 0.03, 0.0), len(soft_mixing.DOMAINS)
    moments = np.zeros((k, k))
    for w, p in rows.values():
        moments += w / total * np.outer(p, p)
    moments += soft_mixing.LEAST_MOMENT * np.eye(k)

    def step(rates):
        sums = [sum(w * r * p[d] for (w, p), r in zip(rows.values(), rates)) / total for d in range(k)]
        return np.array(sums) - target

    got = soft_mixing.mix(docs, labels, target, least_first=1.0, most=4.0).collect()
    rates, gaps, ways = [1.0] * len(rows), [], []
    for _ in range(40):
        gap = step(rates)
        gaps.append(np.abs(gap).max())
        ways.append(rates)
        slope = np.linalg.solve(moments, gap)
        new = []
        for (_, p), r in zip(rows.values(), rates):
            r = r - (float(np.dot(p, slope)) + soft_mixing.RIDGE * (r - 1)) / (1 + soft_mixing.RIDGE)
            new.append(min(4.0, max(1.0 if max(range(k), key=p.__getitem__) == 0 else 0.0, r)))
        rates = new
    at = int(np.argmin(np.abs(np.array(gaps) - got[0].gap)))
    assert abs(gaps[at] - got[0].gap) < 1e-9
    assert max(abs(r.rate - x) for r, x in zip(sorted(got, key=lambda r: r.doc_id), [x for _, x in sorted(zip(rows, ways[at]))])) < 1e-9
    assert got[0].gap <= gaps[0] and all(0 <= r.rate <= 4 for r in got)


def test_odd_labels_and_metadata(spark):
    """A text where a number is expected, and labels of one kind only."""
    rows = [(i, f"word{i % 3} and more words {i}", "en", "s", "many" if i % 2 else "7", i) for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars string, extra int")
    toxic = spark.createDataFrame([(i, 1, 1) for i in range(20)], "doc_id long, quality int, toxic int")
    both = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    assert {tuple(r.p) for r in soft_mixing.mix(frame, toxic).collect()} == {(0.0, 0.0, 1.0)}
    assert {tuple(r.p) for r in soft_mixing.mix(frame, toxic.limit(0)).collect()} == {(1.0, 0.0, 0.0)}
    assert cotrain_quality.score(frame, both).count() == 20
    kept = cotrain_quality.keep(frame, both)
    wanted = {r.doc_id for r in cotrain_quality.score(frame, both).collect() if r.score >= cotrain_quality.LIMIT}
    assert kept.schema == frame.schema and {r.doc_id for r in kept.collect()} == wanted


def test_pipeline_equals_brute_force(spark, docs, labels, tmp_path):
    """Each stage on what the one before kept, held against a plain version of it."""
    for name, frame in (("documents", docs), ("labels", labels)):
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    steps, frames = dict(corpus_pipeline.STAGES), [spark.read.parquet(f"{tmp_path}/documents.parquet")]
    assert list(steps) == ["quality", "simhash", "substrings", "mixing", "tokens"]
    for name, stage in steps.items():
        stage(spark, frames[-1], str(tmp_path)).write.parquet(f"{tmp_path}/{name}.out")
        frames.append(spark.read.parquet(f"{tmp_path}/{name}.out"))
        assert name == "tokens" or frames[-1].schema == frames[0].schema
    rows = [[tuple(r) for r in f.collect()] for f in frames]
    accepted = {(r.doc_id, r.text_hash): r.score >= cotrain_quality.LIMIT for r in cotrain_quality.score(frames[0], labels).collect()}
    hashes = {r.text: r.h for r in frames[0].selectExpr("text", "xxhash64(text) as h").collect()}
    assert sorted(map(repr, rows[1])) == sorted(repr(r) for r in rows[0] if accepted[r[0], hashes[r[1]]])
    found = groups([r[0] for r in rows[1]], [simhash(r[1]) for r in rows[1]], 3)
    assert len(rows[2]) == len(set(found)) and set(map(repr, rows[2])) <= set(map(repr, rows[1]))
    place = {repr(r): g for r, g in zip(rows[1], found)}
    assert len({place[repr(r)] for r in rows[2]}) == len(rows[2])
    seen, cut = {}, []
    for r in sorted(set(rows[2]), key=lambda r: key(r[0])):
        words = (r[1] or "").split()
        for p in range(len(words) - 19):
            seen.setdefault(tuple(words[p:p + 20]), (key(r[0]), p))
    for r in rows[2]:
        words = (r[1] or "").split()
        gone = {q for p in range(len(words) - 19) if seen[tuple(words[p:p + 20])] != (key(r[0]), p) for q in range(p, p + 20)}
        text = " ".join(w for q, w in enumerate(words) if q not in gone) if gone else r[1]
        cut.append((r[0], text, r[2], r[3], len(text) if gone else r[4], *r[5:]))
    assert sorted(map(repr, rows[3])) == sorted(map(repr, cut))
    rated = soft_mixing.mix(frames[3], labels, corpus_pipeline.MIX, least_first=1.0, most=corpus_pipeline.MOST)
    chance = "pmod(xxhash64(doc_id, text_hash), 9007199254740992) / 9007199254740992d"
    times = {(r.doc_id, r.text_hash): r.n for r in rated.selectExpr("doc_id", "text_hash", f"cast(floor(rate + {chance}) as int) as n").collect()}
    marks = {r.text: r.h for r in frames[3].selectExpr("text", "xxhash64(text) as h").collect()}
    assert sorted(map(repr, rows[4])) == sorted(repr(r) for r in rows[3] for _ in range(times[r[0], marks[r[1]]]))
    assert sorted((str(r[0]), list(r[1])) for r in rows[5]) == sorted((str(r[0]), tokens(r[1])) for r in rows[4])


def test_first_of_equal_digests():
    """Also where the halves of different digests agree."""
    digest = np.array([[7, 1], [7, 2], [7, 1], [5, 5], [7, 2]], np.uint64)
    best, n = substrings._first(digest, np.array([3, 9, 2, 1, 4]), np.array([0, 0, 5, 8, 1]), np.array([1, 1, 2, 1, 1]))
    assert sorted(zip(best.tolist(), n.tolist())) == [(2, 3), (3, 1), (4, 2)]


def test_equal_pieces_are_looked_up_once_and_give_the_ids_of_each():
    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    texts = ["", "a\0b\0\0 a", "don't don't  don't\n\n x", "\0", "żółć żółć 12345 12345", "a" * 90 + " " + "a" * 90, "", " "]
    asked = []

    def encode(pieces):
        asked.extend(pieces)
        return [byte_bpe.merge(p.encode(), ranks) for p in pieces]

    encoder = byte_bpe.PieceEncoder(encode)
    for batch in (texts, texts[::-1], [""], []):
        out = encoder(batch)
        assert len(out) == len(batch)
        for text, ids in zip(batch, out):
            pieces, marks = byte_bpe.split_texts([text])
            assert ids.tolist() == [i for p in pieces[:marks[0]] for i in byte_bpe.merge(p.encode(), ranks)]
    assert len(asked) == len(set(asked))


def test_pieces_whose_hashes_agree_in_one_half_stay_apart(monkeypatch):
    points = np.frombuffer("ab cd ab cd".encode("utf-32-le"), np.uint32)
    at = np.array([0, 2, 5, 8])
    ends = np.array([2, 5, 8, 11])
    both = byte_bpe.piece_hashes(points, at, ends)
    monkeypatch.setattr(byte_bpe, "piece_hashes", lambda *a: (np.zeros(4, np.uint64), both[1]))
    some, which = byte_bpe.different(points, at, ends)
    text = "ab cd ab cd"
    assert [text[at[some[w]]:ends[some[w]]] for w in which] == [text[a:b] for a, b in zip(at, ends)]
