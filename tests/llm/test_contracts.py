"""Every query against a brute-force version over the whole small tables."""

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from oracle_check import compare, duck_conn
from tidewater.llm import queries as Q

SF = "/root/testdata/sf0.001"


def rows(spark, name, ids=None):
    out = {r.doc_id: r for r in Q.QUERIES[name](spark, SF).collect()}
    return out


def words(x):
    return x.encode().split()


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def test_op1(spark, tables):
    got, sets = rows(spark, "op1_set_relation_join"), {}
    for d, x in tables.items():
        w = x.encode().lower().split()
        sets[d] = {tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    assert {d: (r.n_shingles, r.component_id) for d, r in got.items()} == {d: (len(s), top(d)) for d, s in sets.items()}


def test_op2(spark, tables):
    got = rows(spark, "op2_secret_scan")
    base = (("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 6),
            ("access", "AKIA[A-Z0-9]+", 0, 0, 20), ("hex", "[0-9a-f]+", 0, 0, 24))
    for d, x in tables.items():
        spans = sorted((m.start(), i, n, m.end()) for i, (n, p, f, g, k) in enumerate(base)
                       for m in re.finditer(p, x, f) if len(m[g]) >= k)
        count = collections.Counter(s[2] for s in spans)
        want = sha(",".join(f"{n}:{a}:{b}" for a, _, n, b in spans))
        r = got[d]
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == (count["assign"], count["access"], count["hex"], want)
        assert set(f"{n}:{a}:{b}" for a, _, n, b in spans) <= set(r.spans.split(","))


def test_op3_finds_every_planted_passage(spark, tables):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    want = {(d, i) for d, x in tables.items() for i, t in items.items() if t in x}
    got = {(r.doc_id, r.item_id): r for r in Q.QUERIES["op3_latent_decontamination"](spark, SF).collect()}
    assert want <= set(got)

    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            row = [0] + [max(row[j + 1], 0) if x != y else None for j, y in enumerate(b)] if False else _next(row, x, b)
        return row[-1]

    def _next(row, x, b):
        out = [0]
        for j, y in enumerate(b):
            out.append(row[j] + 1 if x == y else max(out[j], row[j + 1]))
        return out

    plain = lambda t: [w.strip('.,!?;:"').lower() for w in t.split()]
    for (d, i), r in got.items():
        if (d, i) not in want:  # nothing but true near passages
            a, b = plain(items[i]), plain(tables[d])
            assert lcs(a, b) >= 0.6 * len(a)


def test_op4_oracle(spark):
    r = compare(spark, duck_conn(SF), "op4", Q.QUERIES["op4_revisit_resolution"], Q.ORACLES["op4_revisit_resolution"], SF)
    assert r["ok"], r
    assert r["rows"] > 0


def test_op5(spark, tables):
    got = rows(spark, "op5_fourier_classifier")
    assert set(got) == set(tables)
    for d, r in got.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_op5_against_one_machine(spark, tables):
    """The same model from all rows at once: normal equations by least squares, isotonic values by their max-min formula."""
    import zstandard
    from tidewater.llm.quality_classifier import Settings, statistics
    s, packer = Settings(), zstandard.ZstdCompressor(level=1)
    ids = sorted(tables)
    x = np.array([statistics(tables[d], packer) for d in ids])
    dev = x.std(0)
    z = np.clip((x - x.mean(0)) / np.where(dev > 1e-12, dev, 1.0), -6, 6)
    random = np.random.default_rng(s.seed)
    w = random.normal(0, 1 / s.width, (x.shape[1], s.size))
    z = np.hstack([np.sqrt(2 / s.size) * np.cos(z @ w + random.uniform(0, 2 * np.pi, s.size)), np.ones((len(x), 1))])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    at = [i for i, d in enumerate(ids) if d in labels and zlib.crc32(str(d).encode()) % 5]
    y, m = np.array([labels[ids[i]] for i in at], float), s.size + 1
    penalty = s.ridge * len(at) / m + 1e-9
    weights = np.linalg.lstsq(np.vstack([z[at], np.sqrt(penalty) * np.eye(m)]), np.r_[y, np.zeros(m)], rcond=None)[0]
    raw = z @ weights
    bins = np.clip(np.floor((raw[at] + 0.5) / 2 * s.bins), 0, s.bins - 1)
    groups = sorted((raw[at][bins == b].mean(), int((bins == b).sum()), y[bins == b].mean()) for b in set(bins))
    n, mean = np.array([g[1] for g in groups]), np.array([g[2] for g in groups])
    average = lambda a, b: (n[a:b + 1] * mean[a:b + 1]).sum() / n[a:b + 1].sum()
    steps = [max(min(average(a, b) for b in range(i, len(n))) for a in range(i + 1)) for i in range(len(n))]
    want = np.clip(np.interp(raw, [g[0] for g in groups], steps), 0, 1)
    got = rows(spark, "op5_fourier_classifier")
    assert np.abs(want - [got[d].score for d in ids]).max() < 1e-4


def test_op5_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in Q.QUERIES["op5_fourier_classifier"](spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(got[d].predicted, y) for d, y in labels.items() if d in got and got[d].held_out]
    assert len(held) > 40 and np.mean([p == y for p, y in held]) >= 0.95


def test_op6(spark, tables):
    from tokenizers import Tokenizer
    t, start = Tokenizer.from_file(P.path("word_bpe_49k.json")), 0
    got = rows(spark, "op6_token_files")
    for d in sorted(tables):
        ids = t.encode(tables[d], add_special_tokens=False).ids + [1]
        r = got[d]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_op7(spark, tables):
    got, seen = rows(spark, "op7_recompression"), set()
    for d in sorted(tables):
        w = words(tables[d])
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - 19):
            k = tuple(w[i:i + 20])
            if k in seen:
                gone[i:i + 20] = True
            seen.add(k)
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        r = got[d]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (len(w), int(gone.sum()), sha(kept))


def test_op8(spark, tables):
    got = rows(spark, "op8_compression_bands")
    for d, x in tables.items():
        w = words(x)
        n, found = len(w), collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        again = {j for i in range(n - 4) if found[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
        lines = [s for s in x.split("\n") if words(s)]
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            n, sum(len(y.decode()) for y in w), sum(c in "#*$%&|<>" for c in x), len(lines) - len(set(lines)), len(again))
        assert r.base_failed == (n < 10 or 100 * len(again) > 20 * n)
        assert r.kept == (not r.base_failed and in_bands(x.encode()))


def in_bands(data):
    """The compression verdict, from the limits alone."""
    import zstandard
    from tidewater.llm.quality_rules import Bands
    b, found = Bands(), None
    ratio = lambda part: len(zstandard.ZstdCompressor(level=b.level).compress(part)) / len(part)
    for least, low, high in b.whole:
        if len(data) >= least:
            found = low <= ratio(data) <= high
    if found is None:
        return True
    parts = [data[i:i + b.chunk_bytes] for i in range(0, len(data), b.chunk_bytes)]
    parts = [p for p in parts if 2 * len(p) >= b.chunk_bytes]
    return found and sum(not b.chunk[0] <= ratio(p) <= b.chunk[1] for p in parts) <= b.chunk_share * len(parts)


def test_op9(spark, tables):
    import tiktoken
    from tidewater.llm.bpe import read_ranks
    t = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    got = rows(spark, "op9_byte_bpe")
    for d, x in tables.items():
        ids = t.encode_ordinary(x)
        r = got[d]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(x))


def test_op10(spark, tables):
    got = rows(spark, "op10_histogram_shards")
    slots, sizes = collections.defaultdict(list), collections.Counter()
    for d, x in tables.items():
        r = got[d]
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(x.encode()) + 8, zlib.crc32(x.encode()), "bytes", None)
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(0 <= s < 24 and sorted(v) == list(range(len(v))) for s, v in slots.items())
    most = max(len(x.encode()) for x in tables.values()) + 8
    assert max(sizes.values()) - sum(sizes.values()) / 24 <= most


def test_op11(spark, tables):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got = rows(spark, "op11_tokenization_automaton")
    for d, x in tables.items():
        ids, r = t.encode(x, add_special_tokens=False).ids, got[d]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), sha(np.array(ids, "<u4").tobytes()), sha(t.decode(ids, skip_special_tokens=False)))


def brute_alignments(tables):
    """{doc: (A ids, B ids, groups, links)} straight from the libraries."""
    import sentencepiece
    from tokenizers import Tokenizer
    from tidewater.llm.token_files import byte_letters
    a, b = Tokenizer.from_file(P.path("byte_bpe_50k.json")), sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    a.encode_special_tokens = True
    byte = {x: i for i, x in enumerate(byte_letters())}
    out = {}
    for d, x in tables.items():
        ids_a, ids_b = a.encode(" " + (x or ""), add_special_tokens=False).ids, b.encode(x or "")
        bytes_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(p[1:-1], 16)]) if b.is_byte(i) else p.replace("\u2581", " ").encode()
                   for i, p in ((i, b.id_to_piece(i)) for i in ids_b)]
        want = (" " + (x or "")).encode()
        if not x or b"".join(bytes_a) != want or b"".join(bytes_b) != want:
            out[d] = ([], [], [], [])
            continue
        ends_a, ends_b = (np.cumsum([len(y) for y in z]).tolist() for z in (bytes_a, bytes_b))
        at_a, at_b = ({e: i for i, e in enumerate(z)} for z in (ends_a, ends_b))
        common = sorted(at_a.keys() & at_b.keys())
        groups, i, j = [], 0, 0
        for e in common:
            groups.append((ids_a[i:at_a[e] + 1], ids_b[j:at_b[e] + 1]))
            i, j = at_a[e] + 1, at_b[e] + 1
        out[d] = (ids_a, ids_b, groups, [(ids_a[at_a[e]], ids_b[at_b[e]]) for e in common])
    return out


def brute_counts(found):
    count = collections.Counter(x for f in found.values() for x in f[3])
    most = collections.defaultdict(int)
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    for d, (a, b, groups, links) in found.items():
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        yield (d, len(a), len(b), len(groups), len(links), sum(count[x] == most[x[1]] for x in links),
               sum(count[x] for x in links), sha(shown) if a else "")


def test_op12(spark, tables):
    got = rows(spark, "op12_token_alignment")
    want = list(brute_counts(brute_alignments(tables)))
    assert len(want) == len(got)
    for w in want:
        r = got[w[0]]
        assert (r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == w


def brute_runs(w):
    """Every lag by itself, and the smallest period of every stretch found."""
    n, out = len(w), []
    code = {}
    a = np.array([code.setdefault(x, len(code)) for x in w], np.int64)
    for p in range(1, n // 3 + 1):
        edge = np.diff(np.r_[False, a[p:] == a[:-p], False].astype(np.int8))
        for s, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            size = e - s + p
            if size >= max(24, 3 * p) and not any((a[s + q:s + size] == a[s:s + size - q]).all() for q in range(1, p)):
                out.append((s, size, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def run_row(w):
    from fractions import Fraction
    runs = brute_runs(w)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *four, sha("".join("%d,%d,%d\n" % r for r in runs)),
            sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_op13(spark, tables):
    got, changed = rows(spark, "op13_periodic_runs"), 0
    for d, x in tables.items():
        w = words(x)
        h, n = zlib.crc32(str(d).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i if i < a else a + (i - a) % p] for i in range(n)]
            changed += 1
        r = got[d]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) == run_row(w)
    assert changed > 5 and any(r.n_runs for r in got.values())


def test_pipeline_takes_effect(spark, tables):
    import corpus_pipeline as C
    from tidewater.llm import stages
    from tidewater.llm.common import stored
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    seen = [docs]
    for _, stage in C.STAGES[:-1]:
        out = stored(stage(spark, seen[-1], SF), "t")
        assert out.dtypes == docs.dtypes
        seen.append(out)
    text = [{r.doc_id: r.text for r in d.collect()} for d in seen]
    assert len(text[0]) > len(text[1]) >= len(text[2]) >= len(text[3]) == len(text[4]) > 0
    assert not any(t in x for x in text[3].values() for t in items)
    assert not any(re.search("AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}", x) for x in text[4].values())
    changed = {d for d, x in text[3].items() if text[4][d] != x}
    assert all(stages.MARK in text[4][d] for d in changed)
    final = {r.doc_id: r for r in C.run(spark, SF).collect()}
    assert set(final) == set(text[4]) and all(final[d].decoded_sha256 == sha(x) for d, x in text[4].items())


@pytest.mark.parametrize("n", range(1, 14))
def test_one_query_for_each_operator(n):
    assert sum(q.startswith(f"op{n}_") for q in Q.QUERIES) == 1
