"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns; and the operators' own files and parts."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from test_contracts import brute_alignments, brute_counts, run_row
from tidewater.llm import (bpe, decontaminate, ngram_join, periodic_runs, quality_classifier, quality_rules, recompression,
                           secret_scan, sharding, stages, token_alignment, token_files, tokenization_automaton, warc_revisits)

BYTE_BPE, WORD_BPE = P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json")


def by_id(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_ngram_join(spark, odd):
    out = ngram_join.jaccard_components(odd, 3, ngram_join.Threshold(90, 100))
    got = collections.Counter((r.doc_id, r.component_id) for r in out.collect())
    assert got == {(1, 1): 1, (2, 2): 1, (3, 3): 1, (4, 3): 2, (None, None): 2, (5, 5): 1, (6, 5): 1, (7, 7): 1, (8, 8): 1, (9, 8): 1, (10, 10): 1}
    assert ngram_join.jaccard_components(odd.limit(0), 3).count() == 0


def test_ngram_join_random_near_copies(spark, settings=((3, 90), (5, 80), (1, 50))):
    rnd, base = random.Random(5), [f"w{i}" for i in range(4000)]
    rows = []
    for f in range(12):
        size = rnd.choice([8, 40, 300])
        text = [rnd.choice(base) for _ in range(size)]
        for _ in range(25):
            t = list(text)
            for _ in range(rnd.randint(0, max(1, size // 30))):
                t[rnd.randrange(size)] = rnd.choice(base)
            rows.append((len(rows), " ".join(t)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for n, num in settings:
        hashes = ngram_join.WordHashes()
        sets = {d: set(ngram_join.shingle_set(x, n, hashes).tolist()) for d, x in rows}
        root = {d: d for d in sets}

        def top(d):
            while root[d] != d:
                d = root[d]
            return d

        for a in range(len(rows)):
            for b in range(a + 1, len(rows)):
                if 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                    x, y = sorted((top(a), top(b)))
                    root[y] = x
        got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(docs, n, ngram_join.Threshold(num, 100)).collect()}
        assert got == {d: top(d) for d in sets}


def test_ngram_join_of_many_short_texts(spark):
    """Short sets often have empty blocks: no link is lost, and they gather in no list."""
    rnd, base = random.Random(6), [f"w{i}" for i in range(3000)]
    rows = []
    for _ in range(60):
        text = [rnd.choice(base) for _ in range(rnd.choice([3, 5, 8, 12, 20, 30, 45]))]
        for _ in range(rnd.randint(1, 8)):
            t = list(text)
            for _ in range(rnd.randint(0, 2)):
                t[rnd.randrange(len(t))] = rnd.choice(base)
            if rnd.random() < 0.5:
                t += [rnd.choice(base) for _ in range(rnd.randint(1, 3))]
            rows.append((len(rows), " ".join(t)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for n, num in ((1, 50), (2, 70)):
        hashes = ngram_join.WordHashes()
        sets = {d: set(ngram_join.shingle_set(x, n, hashes).tolist()) for d, x in rows}
        root = {d: d for d in sets}

        def top(d):
            while root[d] != d:
                d = root[d]
            return d

        for a in range(len(rows)):
            for b in range(a + 1, len(rows)):
                if 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                    x, y = sorted((top(a), top(b)))
                    root[y] = x
        got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(docs, n, ngram_join.Threshold(num, 100)).collect()}
        assert got == {d: top(d) for d in sets}


@pytest.mark.parametrize("num", [80, 90])
@pytest.mark.parametrize("size", [1, 4, 10, 20, 60, 300])
def test_unrelated_sets_share_no_list(size, num):
    rnd, threshold = np.random.default_rng(size), ngram_join.Threshold(num, 100)
    ranges = ngram_join.bands(threshold, 4 * size + 4)
    own = next(i for i, (_, high) in enumerate(ranges) if size <= high)
    keys = collections.Counter()
    for _ in range(4000):
        s = np.sort(rnd.integers(0, 1 << 63, size, dtype=np.uint64) << np.uint64(1))
        for band in (own, own + 1):
            keys.update(set(ngram_join.block_keys(s, band, ranges[band][1], threshold).tolist()))
    assert max(keys.values()) == 1


def test_filter_before_texts_move(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc"), F.lit("x").alias("text"))
    asked = rows.where("doc % 100 = 7").select("doc")
    left = {r.doc for r in ngram_join._filtered(rows, asked).collect()}
    assert {r.doc for r in asked.collect()} <= left and len(left) < 300
    assert ngram_join._filtered(rows, asked.limit(0)).count() == 0


def test_member_links_over_parts(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "TOGETHER", 7)  # the members of one leader meet in many tasks
    test_ngram_join_random_near_copies(spark, ((1, 50),))


def test_secret_ledger(spark, odd, scratch):
    assert secret_scan.scan_history(odd).count() == odd.count()
    assert secret_scan.scan_history(odd.limit(0)).count() == 0
    path = scratch("ledger")
    first = spark.createDataFrame([("a", 1, "token = abcdef123"), ("b", 1, "token = abcdef123"), ("c", 1, "plain")],
                                  "path string, version int, text string")
    n = len(secret_scan.RULES)
    secret_scan.scan_unseen(first, path)
    assert secret_scan.read_ledger(spark, path).count() == 2 * n  # two blobs, each rule once
    second = first.union(spark.createDataFrame([("a", 2, "AKIA" + "A" * 16)], first.schema))
    found = secret_scan.scan_history(second, path)
    assert secret_scan.read_ledger(spark, path).count() == 3 * n  # the one new blob alone was scanned
    assert {(r.path, r.version): [s.kind for s in r.found or []] for r in found.collect()} == {
        ("a", 1): ["assign"], ("b", 1): ["assign"], ("c", 1): [], ("a", 2): ["access"]}
    newer = tuple(r if r.name != "hex" else secret_scan.Rule("hex", 2, "[0-9a-f]{6,}") for r in secret_scan.RULES)
    found = secret_scan.scan_history(second, path, newer)  # a new version of a rule is scanned again, alone
    assert secret_scan.read_ledger(spark, path).count() == 3 * n + 3
    assert [s.kind for r in found.where("path = 'b'").collect() for s in r.found] == ["assign", "hex"]


def test_secret_kinds_beyond_the_base(spark):
    part = "eyJ" + "aB3_" * 3
    rows = [("pem", "x -----BEGIN RSA PRIVATE KEY----- y", 2, 33), ("jwt", f"a {part}.{part}.{'Zz09' * 3}.", 2, 2 + 15 * 2 + 2 + 12),
            ("github", "see ghp_" + "a1B2" * 9 + "!", 4, 4 + 4 + 36)]
    docs = spark.createDataFrame([(k, x) for k, x, _, _ in rows], "path string, text string")
    found = {r.path: [(s.kind, s.start, s.end) for s in r.found] for r in secret_scan.scan_history(docs).collect()}
    assert found == {k: [(k, a, b)] for k, _, a, b in rows}
    near = [("pem", "-----BEGIN PUBLIC KEY-----"), ("jwt", "eyJabc.eyJabc.abc"), ("github", "ghp_" + "z" * 35)]
    assert all(not r.found for r in secret_scan.scan_history(spark.createDataFrame(near, docs.schema)).collect())


def test_a_pair_that_two_scans_appended_counts_once(spark, scratch):
    docs, path = spark.createDataFrame([("a", "token = abcdef123")], "path string, text string"), scratch("ledger")
    ledger = secret_scan.scan_unseen(docs, path)
    twice = ledger.union(ledger)
    assert [len(r.found) for r in secret_scan.findings(docs, twice).collect()] == [1]


def test_secret_spans_and_redaction():
    find = secret_scan.BASE_RULES[0].finder()
    for text, want in (("Token=abcde", 0), ("TOKEN: 'abcdef'", 1), ("secret=token:abcdefgh", 0), ("api_key == x", 0), ("ſecret=abcdefg", 0)):
        assert len(find(text, text.lower())) == want, text
    assert secret_scan.redact("ab secret cd", [(3, 6), (5, 9)], "*") == "ab * cd"


def test_decontamination(spark, odd):
    words = [f"term{i}" for i in range(400)]
    rnd = random.Random(1)
    item = rnd.sample(words, 30)
    other = rnd.sample(words, 25)
    noise = lambda n: [f"noise{rnd.randint(0, 5000)}" for _ in range(n)]
    para = [w for i, w in enumerate(item) if i % 5 != 1]  # a fifth of the words left out
    half = item[:12]
    docs = [(1, " ".join(noise(200) + item + noise(100))), (2, " ".join(noise(50) + para + noise(300))), (3, " ".join(noise(50) + half + noise(30))),
            (4, " ".join(noise(400))), (5, None), (6, ""), (7, " ".join(w.upper() + "," for w in item)), (8, " ".join(reversed(item))),
            (None, " ".join(item)), (9, " ".join(noise(20) + ["term1"] * 400 + item + ["term1"] * 100))]
    bench = [(1, " ".join(item)), (2, " ".join(other)), (3, None), (4, ""), (None, " ".join(other)), (1, " ".join(item))]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(bench, "item_id long, text string")
    for settings in (decontaminate.Settings(), decontaminate.Settings(block=1)):
        got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(d, b, settings).collect()}
        assert got == {(1, 1), (2, 1), (7, 1), (None, 1), (9, 1)}
    assert decontaminate.contaminated(d, b.limit(0)).count() == 0
    assert decontaminate.contaminated(d.limit(0), b).count() == 0
    assert decontaminate.contaminated(odd, b).count() == 0


def paraphrase(rnd, words, share):
    """``share`` of the words in their order, the whole answer part among them."""
    answer = max(3, -(-len(words) // 5))
    kept = set(rnd.sample(range(len(words) - answer), max(0, -(-round(share * 100) * len(words) // 100) - answer)))
    return [w for i, w in enumerate(words) if i in kept or i >= len(words) - answer]


def planted(rnd, texts, passages):
    """(rows, pairs): each document of ``passages`` (doc_id -> list of (item_id, words)) gets them at random places."""
    rows = []
    for d, x in sorted(texts.items()):
        words = x.split()
        for _, p in passages.get(d, ()):
            at = rnd.randint(0, len(words))
            words[at:at] = p
        rows.append((d, " ".join(words)))
    return rows, {(d, i) for d, found in passages.items() for i, _ in found}


def test_decontamination_of_a_passage_in_a_third_of_documents(spark):
    sf, rnd = "/root/testdata/sf0.01", random.Random(7)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    items = {r.item_id: r.text.split() for r in spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").limit(6).collect()}
    ids, docs = sorted(items), sorted(texts)
    # one item word for word in a third of the documents, another as paraphrases in another third, the others in one document each
    passages = {d: [(ids[0], items[ids[0]])] for d in docs[::3]} | {d: [(ids[1], paraphrase(rnd, items[ids[1]], 0.65))] for d in docs[1::3]}
    passages |= {docs[2 + 3 * n]: [(i, paraphrase(rnd, items[i], 0.65))] for n, i in enumerate(ids[2:])}
    rows, want = planted(rnd, texts, passages)
    got = decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string").repartition(4),
                                     spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string"))
    assert not want - {(r.doc_id, r.item_id) for r in got.collect()}


def test_decontamination_of_short_items_beside_a_long_one(spark):
    sf, rnd = "/root/testdata/sf0.01", random.Random(8)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    items = {r.item_id: r.text.split() for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    docs, long_id = sorted(texts), max(items) + 1
    longest = [w for d in docs[-40:] for w in texts.pop(d).split()][:1000]
    assert len(longest) == 1000
    docs = docs[:-40]
    passages = {d: [(i, paraphrase(rnd, items[i], 0.65))] for d, i in zip(docs[::9], sorted(items))}
    passages[docs[1]] = [(long_id, paraphrase(rnd, longest, 0.65))]
    rows, want = planted(rnd, texts, passages)
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = []
    for bench in (items, items | {long_id: longest}):
        b = spark.createDataFrame([(i, " ".join(w)) for i, w in bench.items()], "item_id long, text string")
        got.append({(r.doc_id, r.item_id): (r.share, r.answer_share) for r in decontaminate.contaminated(d, b).collect()})
    assert not want - set(got[1])
    assert {k: v for k, v in got[1].items() if k[1] != long_id} == got[0]


def test_decontamination_against_brute_force(spark, tmp_path):
    """All pairs by the rule, from every passage of every document of sf0.1, and no others."""
    sf, rnd, settings = "/root/testdata/sf0.1", random.Random(9), decontaminate.Settings()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    items = {r.item_id: r.text.split() for r in spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").limit(12).collect()}
    docs, (often, *others) = sorted(texts), sorted(items)
    passages = {d: [(often, paraphrase(rnd, items[often], 0.6 + 0.2 * rnd.random()))] for d in docs[::3]}
    passages |= {docs[3 * n + 1]: [(i, paraphrase(rnd, items[i], share))]
                 for n, (i, share) in enumerate((i, share) for i in others for share in (0.6, 0.65, 0.7, 0.75, 0.8))}
    rows, planned = planted(rnd, texts, passages)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(8).write.parquet(f"{tmp_path}/documents")
    got = decontaminate.contaminated(spark.read.parquet(f"{tmp_path}/documents"),
                                     spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string"))
    plain = {i: [x for x in map(decontaminate.plain, w) if x] for i, w in items.items()}
    known = {x: n for n, x in enumerate({x for w in plain.values() for x in w})}
    numbers = {i: [known[x] for x in w] for i, w in plain.items()}
    want = set()
    for d, x in rows:
        words = [known.get(decontaminate.plain(w), -1) for w in x.split()]
        for at in range(0, max(len(words) - 96, 1), 32):
            passage = words[at:at + 128]
            there = set(passage)
            for i, own in numbers.items():
                if sum(w in there for w in own) < settings.paraphrase * len(own):
                    continue
                share = decontaminate.common_subsequence(own, passage) / len(own)
                answer = own[-max(3, -(-len(own) // 5)):]
                if share >= settings.copy or share >= settings.paraphrase and (
                        decontaminate.common_subsequence(answer, passage) >= settings.answer * len(answer)):
                    want.add((d, i))
    assert planned <= want
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want


def test_decontamination_of_many_rows_without_a_key(spark):
    rnd = random.Random(10)
    item = [f"term{i}" for i in range(30)]
    texts = [" ".join([f"n{rnd.randint(0, 500)}" for _ in range(40)] + item * (k % 3 == 0) + [f"x{k}"]) for k in range(300)]
    docs = spark.createDataFrame([(None, x) for x in texts] + [(7, texts[0]), (8, texts[1])], "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "other words of another item that is nowhere")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()} == {(None, 1), (7, 1)}


def test_decontamination_reads_each_text_once(spark):
    item = " ".join(f"term{i}" for i in range(30))
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    docs = spark.createDataFrame([(k, f"n{k} {item} x{k}" if k % 3 == 0 else f"term{k % 30} and x{k}") for k in range(60)],
                                 "doc_id long, text string").repartition(3).mapInArrow(counted, "doc_id long, text string")
    got = decontaminate.contaminated(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(k, 1) for k in range(0, 60, 3)}
    assert read.value == 60


class Here:
    """Batches in place of a DataFrame: a step's rows as they come, in this process."""

    def __init__(self, batches):
        self.batches = batches

    def mapInArrow(self, run, schema):
        return list(run(iter(self.batches)))


def block_of(texts, items):
    """The items' block, weighed, and the numbered texts."""
    import pyarrow as pa
    block = decontaminate.Block(items, decontaminate.Settings())
    texts = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc", "text"])
    *numbered, sums = decontaminate._numbered(Here([texts]), block)
    df = np.frombuffer(sums.column("sums")[0].as_buffer())
    block.weigh(df[1:].astype(int), int(df[0]))
    return block, numbered


def random_block():
    rnd = random.Random(14)
    often, rare = [f"often{i}" for i in range(30)], [f"rare{i}" for i in range(60)]
    items = [(i, " ".join(rnd.sample(rnd.sample(often, 15) + rnd.sample(rare, 12), 27))) for i in range(6)]
    items.append((6, " ".join(rnd.choice(often + rare) for _ in range(90))))  # longer: a group of its own
    texts = []
    for _ in range(120):
        words = [f"x{rnd.randint(0, 900)}" if rnd.random() < 0.6 else rnd.choice(often) for _ in range(rnd.randint(0, 300))]
        own, at = rnd.choice(items)[1].split(), rnd.randint(0, len(words))
        some = set(rnd.sample(own, rnd.randint(1, len(own) // 2)))
        words[at:at] = [w for w in own if w in some or rnd.random() < 0.2 * (w[0] == "r")]
        texts.append(" ".join(words))
    return block_of(texts, items)


def passages_of(block, numbered):
    """(group, words with their counts, item, share of the item's squared length that the words hold) of all pairs that share a feature."""
    items = block.item_matrix()
    for batch in numbered:
        for _, numbers, counts in decontaminate._numbers(batch, block):
            for group in range(len(block.strides)):
                _, _, w, tf, offsets = block.passages(numbers, counts, group)
                for a, b in zip(offsets, offsets[1:]):
                    for i in np.flatnonzero(block.group == group):
                        if share := (items[i, w[a:b]] ** 2).sum():
                            yield group, w[a:b], tf[a:b], i, share


def test_decontamination_compares_every_candidate_by_words(monkeypatch):
    block, numbered = random_block()
    want = [pair for pair in passages_of(block, numbered) if pair[-1] >= block.asked[pair[-2]]]
    whole, compared = [tuple(words) for _, words in block.items], []

    def counted(a, b, *places, count=decontaminate.common_subsequence):
        if tuple(a) in whole:
            compared.append(whole.index(tuple(a)))
        return count(a, b, *places)

    monkeypatch.setattr(decontaminate, "common_subsequence", counted)
    decontaminate._hits(Here(numbered), block, np.zeros((len(block.words), 0)))
    assert len(want) > 300
    assert sorted(compared) == sorted(pair[-2] for pair in want)


def test_decontamination_compares_every_passage_in_the_latent_space():
    block, numbered = random_block()
    directions = np.random.default_rng(2).normal(size=(len(block.words), 5))
    items, space = block.item_matrix(), np.linalg.qr(np.hstack([block.item_matrix().T, directions]))[0]
    want, got = {}, {}
    for at, (group, w, tf, i, _) in enumerate(passages_of(block, numbered)):
        x = np.zeros(len(block.words))
        x[w] = block.idf[w] * (1 + np.log(tf))
        want[at] = x @ items[i] / np.linalg.norm(x @ space)
    block.asked[:] = 0  # every pair that shares a feature
    found, at = decontaminate.Space(block, directions), 0
    for batch in numbered:
        for _, numbers, counts in decontaminate._numbers(batch, block):
            for group in range(len(block.strides)):
                _, _, w, tf, offsets = block.passages(numbers, counts, group)
                for near in found.near(group, w, decontaminate._weights(w, tf, offsets, block.idf), offsets):
                    for _, _, cosine in zip(*near):
                        got[at], at = cosine, at + 1
    assert len(want) == len(got) > 1000
    assert all(abs(got[k] - want[k]) < 1e-5 for k in want)


def test_words_are_numbered_together_as_one_by_one():
    import pyarrow as pa
    rnd = random.Random(12)
    known = ["a", "term", "sixteen-letters.", "seventeen-letters", "été", "中文", "ok", "i\u0307", "k", "re-do"]
    words = {w: n for n, w in enumerate(known)}
    bits = ["  ", "\n", "\x0b", "\r\n", "\x00", "\x1c", "\xa0", "\x85", "...", "'", "«", "”", "É", "\u0130", "\u212a", "x" * 20, *known]
    texts = ["".join((lambda x: x.upper() if rnd.random() < 0.2 else x)(rnd.choice([" ", *bits])) for _ in range(rnd.randint(0, 25)))
             for _ in range(3000)] + [None, "", " ", "term", "a\x00", "TERM,"]
    for some in (texts, [None, ""], [" ", "", "\n"], []):
        got, counts = decontaminate.Vocabulary(words).numbers(pa.array(some, pa.string()))
        want = [[words.get(decontaminate.plain(w.decode()), -1) for w in (x or "").encode().split()] for x in some]
        assert counts.tolist() == [len(w) for w in want]
        assert got.tolist() == [n for w in want for n in w]
    column = pa.array(texts).slice(11, 50)
    assert decontaminate.Vocabulary(words).numbers(column)[1].tolist() == [len((x or "").encode().split()) for x in texts[11:61]]


def test_svd_against_numpy(spark):
    rnd = np.random.default_rng(0)
    dense = (rnd.random((300, 40)) < 0.2) * rnd.integers(1, 4, (300, 40))
    dense[:, :5] += (rnd.random((300, 1)) < 0.4) * 3  # a strong common direction
    dense = dense[dense.any(1)]
    rows = [(i, 0, np.flatnonzero(x).tolist(), x[x > 0].tolist()) for i, x in enumerate(dense)]
    idf = np.linspace(1, 2, 40)
    vectors = spark.createDataFrame(rows, decontaminate.VECTORS).repartition(3)
    got = decontaminate.randomised_svd(vectors, idf, decontaminate.Settings(rank=4, oversample=30))
    x = np.where(dense > 0, idf * (1 + np.log(np.maximum(dense, 1))), 0)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = np.linalg.svd(x)[2][:1].T
    assert np.linalg.norm(got.T @ want) > 0.99


def test_common_subsequence():
    def slow(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
            row = new
        return row[-1]

    rnd = random.Random(3)
    for _ in range(300):
        a, b = ([rnd.randint(0, 6) for _ in range(rnd.randint(0, 90))] for _ in range(2))
        assert decontaminate.common_subsequence(a, b) == slow(a, b)


def test_revisits(spark):
    schema = ("record_id long, url string, ts long, kind string, etag string, last_modified string, headers map<string,string>, "
              "payload_sha256 string, extra int")
    h = {"ETag": "a", "X": "1", "Date": "d0"}
    rows = [(1, "http://WWW.a.com:80/x/?b=2&a=1&utm_z=1#f", 10, "response", "a", None, h, "p1"), (2, "https://a.com/x?a=1&b=2", 20, "revisit", "W/a", None, {"date": "d1", "X": "2"}, None),
            (3, "a.com", 5, "revisit", None, None, None, None), (4, "http://a.com/x?a=1&b=2", 9, "revisit", "a", None, None, None),
            (5, "http://a.com/x?a=1&b=2", 10, "revisit", "z", None, None, None), (0, "http://a.com/x?a=1&b=2", 10, "revisit", "a", None, None, None),
            (6, None, 30, "revisit", "a", None, None, None), (7, "http://a.com/x?a=1&b=2", None, "revisit", "a", None, None, None),
            (8, "http://a.com/x?a=1&b=2", 900_000, "revisit", None, None, None, None), (None, "http://b.com", 1, "response", None, "m", None, "p2"),
            (9, "http://b.com/", 2, "revisit", "q", "m", None, None), (9, "http://b.com/", 2, "revisit", "q", "n", None, None), (10, "http://b.com/", 3, None, None, None, None, None)]
    records = spark.createDataFrame([(*r, 1) for r in rows], schema)
    for width in (6, 3600, 10 ** 7):
        got = collections.Counter((r.record_id, r.outcome, r.response_id, r.payload_sha256) for r in warc_revisits.resolve_revisits(records, width).collect())
        assert got == collections.Counter([(2, "resolved", 1, "p1"), (3, "orphan", None, None), (4, "orphan", None, None), (5, "mismatch", 1, None), (0, "orphan", None, None),
                                           (6, "orphan", None, None), (7, "orphan", None, None), (8, "unvalidated", 1, "p1"), (9, "resolved", None, "p2"), (9, "mismatch", None, None)])
    merged = {r.record_id: r.headers for r in warc_revisits.resolve_revisits(records).collect()}[2]
    assert merged == {"ETag": "a", "X": "1", "date": "d1"}
    assert warc_revisits.resolve_revisits(records.limit(0)).count() == 0


def test_revisits_of_a_url_with_many_captures_at_once(spark):
    placed = spark.range(6000).selectExpr(
        "id as record_id", "if(id % 3 = 0, 'a.com/x', concat('b.com/', id % 700)) as url", "1600000000 + id div 60 as ts",
        "if(id % 21 = 0, 'response', 'revisit') as kind", "cast(null as string) as etag", "cast(null as string) as last_modified",
        "cast(null as map<string,string>) as headers", "cast(id as string) as payload_sha256")
    most = warc_revisits.sliced(placed, 6 * 3600, 100).groupBy("url", "slice").count().agg(F.max("count")).first()[0]
    assert most <= 100 + 20  # the records of a second stay together
    got = [{(r.record_id, r.response_id, r.outcome) for r in warc_revisits.resolve_revisits(placed, 6 * 3600, n).collect()} for n in (100, 10 ** 6)]
    assert got[0] == got[1] and len(got[0]) == 6000 - 286


def test_classifier(spark, odd):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 11)] + [(None, 1, 1), (3, 7, None), (4, None, None)], "doc_id long, quality int, toxic int")
    got = quality_classifier.quality_scores(odd, labels)
    assert got.count() == odd.count() and got.where("score between 0 and 1").count() == odd.count()
    none = quality_classifier.quality_scores(odd, labels.limit(0))
    assert {r.score for r in none.collect()} == {0.5}
    one = quality_classifier.quality_scores(odd, labels.where("quality = 1"))
    assert min(r.score for r in one.collect()) > 0.99
    assert quality_classifier.quality_scores(odd.limit(0), labels).count() == 0


def test_isotonic_and_fourier():
    xs, ys = quality_classifier.isotonic([(0.0, 1, 0.5), (1.0, 1, 0.0), (2.0, 2, 1.0), (3.0, 1, 0.7)])
    assert ys == sorted(ys) and xs == sorted(xs) and ys[0] == 0.25 and abs(ys[-1] - 0.9) < 1e-9
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(40, 5))
    m = quality_classifier.Model(np.zeros(5), np.ones(5), quality_classifier.Settings(size=4000, width=2.0))
    z = m.fourier(x)[:, :-1]
    gap = ((x[:, None] - x[None]) ** 2).sum(-1)
    assert np.abs(z @ z.T - np.exp(-gap / (2 * 2.0 ** 2))).max() < 0.08  # the kernel that the features stand for


def test_sums_add_up_in_rounds(spark):
    parts = spark.createDataFrame([(np.full(3, float(i)).tobytes(),) for i in range(100)], "sums binary").repartition(100)
    assert quality_classifier._add_up(parts, 100, way=4).tolist() == [4950.0] * 3


def test_token_files(spark, odd, scratch):
    from tokenizers import Tokenizer
    folder = scratch("tokens")
    index = token_files.write_tokens(odd, folder, WORD_BPE, frame_bytes=4000)
    assert index.count() > 3
    got = token_files.read_tokens(index, folder)
    t = Tokenizer.from_file(WORD_BPE)
    rows = sorted(((r.doc_id is not None, r.doc_id, r.text is not None, r.text or "") for r in odd.collect()))
    want, start = [], 0
    for _, d, _, x in rows:
        n = len(t.encode(x, add_special_tokens=False).ids) + 1
        want.append((d, start, n))
        start += n
    assert sorted(((r.doc_id, r.start, r.n_tokens) for r in got.collect()), key=lambda r: r[1]) == want
    some = token_files.read_tokens(index, folder, [3, 5, 99])
    assert sorted(r.doc_id for r in some.collect()) == [3, 5]
    assert token_files.token_files(odd.limit(0), WORD_BPE).count() == 0


def test_token_file_checks_its_frames(tmp_path):
    w = token_files.FrameWriter(str(tmp_path), 0, frame_bytes=64)
    for i in range(20):
        w.add(i, np.arange(10 * i, dtype="<u4").tobytes())
    frames = w.close()
    r = token_files.FrameReader(str(tmp_path), frames[0][0])
    assert [d for k in range(len(frames)) for d in r.frame(k)[0]] == list(range(20))
    import zstandard
    path = tmp_path / frames[0][0]
    data = path.read_bytes()  # any zstd reader sees plain frames, then a skippable one
    assert len(zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()) == sum(e[1] for e in r.entries)
    path.write_bytes(data[:200] + bytes([data[200] ^ 1]) + data[201:])
    with pytest.raises(Exception):
        for k in range(len(frames)):
            token_files.FrameReader(str(tmp_path), frames[0][0]).frame(k)


def test_word_encoder_equals_the_library():
    e, rnd = token_files.Encoder(WORD_BPE), random.Random(4)
    texts = ["Don't 'S. it's, a.b .", "<|endoftext|> x<|endoftext|>.", "İ I. ſ ŉ", "Été, ẞ Å", "12, 3. 中,"]
    texts += ["".join(rnd.choice("aeTéÀ.,'s1 ǅİßΩ中­") for _ in range(9)) for _ in range(3000)]
    for x, ids in zip(texts, e.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == e.tokenizer.encode(x, add_special_tokens=False).ids, x


def brute_repeats(rows, window=20):
    seen, out = {}, collections.Counter()
    rows = [(d, (x or "").encode().split()) for d, x in rows]
    for d, w in rows:
        if d is not None:
            place = recompression.row_tag(w)
            for i in range(len(w) - window + 1):
                k = tuple(w[i:i + window])
                seen[k] = min(seen.get(k, (d, i, place)), (d, i, place))
    for d, w in rows:
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - window + 1 if d is not None else 0):
            if seen[tuple(w[i:i + window])] < (d, i, recompression.row_tag(w)):
                gone[i:i + window] = True
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[(d, len(w), int(gone.sum()), hashlib.sha256(kept).hexdigest())] += 1
    return out


def test_words_before_marks_need_not_the_whole_way(monkeypatch):
    from tokenizers import Tokenizer
    library, encoder, rnd = Tokenizer.from_file(WORD_BPE), token_files.Encoder(WORD_BPE), random.Random(6)
    letters, marks = "abcSTRéÖñ", "!%$#*&'\"_-.,;:<|>()[]{}~^`@/\\+="
    words = ["".join(rnd.choices(letters, k=rnd.randint(1, 6))) + "".join(rnd.choices(marks, k=rnd.randint(1, 5))) for _ in range(3000)]
    whole = []
    monkeypatch.setattr(token_files.Encoder, "whole", lambda self, word: whole.append(word))
    got = encoder.encode(words)
    assert not whole and [np.frombuffer(x, "<u4").tolist() for x in got] == [
        library.encode(w, add_special_tokens=False).ids for w in words]
    monkeypatch.undo()
    text = "it's 'tis !! a<|endoftext|>!! x<|endoftext|> rock'n'roll... A1! ½!! ǆ!"
    assert np.frombuffer(token_files.Encoder(WORD_BPE).encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_recompression(spark, odd):
    got = collections.Counter(tuple(r) for r in recompression.drop_repeats(odd).collect())
    assert got == brute_repeats([(r.doc_id, r.text) for r in odd.collect()])
    assert recompression.drop_repeats(odd.limit(0)).count() == 0


@pytest.mark.parametrize("letters", [2, 4, 30])
def test_recompression_random(spark, letters):
    rnd = random.Random(letters)
    word = lambda: f"w{rnd.randint(1, letters)}"
    passages = [[word() for _ in range(rnd.randint(15, 60))] for _ in range(6)] + [["w1"] * 45]
    rows = []
    for d in range(60):
        w = []
        for _ in range(rnd.randint(0, 4)):
            w += [word() for _ in range(rnd.randint(0, 30))]
            p = rnd.choice(passages)
            a = rnd.randint(0, 10)
            w += p[a:a + rnd.randint(10, 60)]
        rows.append((d, " ".join(w)))
    for ids in (60, 9, 2):  # one row an id; several texts of one id, equal ones among them
        placed = [(d % ids, x) for d, x in rows] + ([(d % ids, x) for d, x in rows[::7]] if ids < 60 else [])
        docs = spark.createDataFrame(placed, "doc_id long, text string").repartition(4)
        for window in (20, 27):
            got = collections.Counter(tuple(r) for r in recompression.drop_repeats(docs, window).collect())
            assert got == brute_repeats(placed, window)


def test_recompression_keeps_what_only_one_row_of_an_id_has(spark):
    text = lambda letter, a, b: " ".join(f"{letter}{i}" for i in range(a, b))
    rows = [(1, text("a", 0, 25)), (7, text("a", 0, 25)), (7, text("u", 0, 40)), (9, text("u", 15, 40))]
    got = {(r.doc_id, r.n_words): r.n_removed for r in recompression.drop_repeats(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 25): 0, (7, 25): 25, (7, 40): 0, (9, 25): 25}


def test_equal_windows_have_equal_phrases():
    rnd = np.random.default_rng(1)
    core = rnd.integers(0, 6, 20).astype(np.uint64)
    names = set()
    for _ in range(200):
        before, after = (rnd.integers(0, 6, rnd.integers(0, 12)).astype(np.uint64) for _ in range(2))
        h = recompression.mixed(np.concatenate([before, core, after]))
        name, _ = recompression.phrases(h, np.zeros(len(h), np.int64), np.array([len(before)]), 20)
        names.add(int(name[0]))
    assert len(names) == 1


def test_quality_rules(spark, odd):
    got = quality_rules.quality_rules(odd)
    assert got.count() == odd.count() and got.where("doc_id in (1, 2, 7) and n_words = 0 and base_failed and ratio >= 0").count() == 3
    assert quality_rules.quality_rules(odd.limit(0)).count() == 0
    rnd = random.Random(0)
    noise = "".join(chr(rnd.randint(0x4e00, 0x9fff)) + (" " if i % 7 == 0 else "") for i in range(9000))  # hardly compressible
    prose = " ".join("".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(2, 9))) for _ in range(900))
    lines = "\n".join(f"row {i % 3} of the same old table {i}" for i in range(900))  # repeats, but no 5 words recur much
    assert quality_rules.passes(prose) and not quality_rules.passes(lines) and not quality_rules.passes("a b c")
    bands = quality_rules.Bands()
    import zstandard
    packer = zstandard.ZstdCompressor(level=3)
    for text, fine in ((prose, True), (lines, False), ("x" * 5000, False)):
        assert quality_rules.in_bands(len(text.encode()), *quality_rules.ratios(text.encode(), bands, packer), bands) == fine
    assert quality_rules.ratios(noise.encode(), bands, packer)[0] > 0.4


def test_bpe(spark, odd):
    import tiktoken
    ranks = bpe.read_ranks(BYTE_BPE)
    t = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = collections.Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in bpe.encode_documents(odd, BYTE_BPE, P.PATTERN).collect())
    want = collections.Counter()
    for r in odd.collect():
        ids = t.encode_ordinary(r.text or "")
        want[(r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())] += 1
    assert got == want
    assert bpe.encode_documents(odd.limit(0), BYTE_BPE, P.PATTERN).count() == 0


def test_bpe_words_and_round_trip(spark):
    import tiktoken
    ranks = bpe.read_ranks(BYTE_BPE)
    t = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(8)
    words = ["a" * n for n in range(1, 40)] + ["".join(rnd.choice("abcdethé中") for _ in range(rnd.randint(1, 60))) for _ in range(400)]
    start = bpe.Start(ranks)
    df = spark.createDataFrame([(w, start(w.encode())) for w in words], "word string, state array<bigint>")
    for r in bpe.decode_ids(bpe.encode_words(df, ranks), ranks).collect():
        assert bytes(r.decoded) == r.word.encode()
        if r.word.encode() not in ranks:
            assert list(r.ids) == t._encode_single_piece(r.word.encode()), r.word
    for w in words + ["xyz" * 3000, "the" * 2000 + "q"]:
        assert bpe.merge_long(w.encode(), ranks) == t._encode_single_piece(w.encode())


def test_bpe_fold_of_masks_on_random_vocabularies(spark):
    """Words of 1 to 30 bytes against the heap; a vocabulary whose tokens are made out of their turn is told."""
    rnd, rows, regular = random.Random(13), [], 0
    for _ in range(60):
        tokens = [b"a", b"b", b"c"]
        for _ in range(rnd.randint(1, 25)):
            tokens.append(rnd.choice(tokens) + rnd.choice(tokens))
        ranks = {bytes([x]): x for x in range(256)}
        for token in dict.fromkeys(tokens[3:]):
            ranks.setdefault(token, len(ranks))
        start = bpe.Start(ranks)
        regular += start.spans.regular
        for _ in range(40 * start.spans.regular):
            word = "".join(rnd.choice("aabc") for _ in range(rnd.randint(1, 30))).encode()
            if word not in ranks:
                rows.append((start(word), bpe.merge_long(word, ranks)))
    assert regular > 20 and len(rows) > 500
    got = spark.createDataFrame(rows, "state array<bigint>, want array<bigint>").select(bpe.fold_spans(F.col("state")).alias("ids"), "want")
    assert got.where("ids != want").collect() == []


def test_bpe_of_tokens_out_of_their_turn(spark):
    ranks = {bytes([x]): x for x in range(256)} | {b"abc": 256, b"xyz": 257, b"ab": 258, b"cd": 259}
    start = bpe.Start(ranks)
    assert not start.spans.regular  # abc comes from ab, whose rank is higher
    del ranks[b"abc"]
    assert bpe.Start(ranks).spans.regular  # xyz is made by no merge
    for extra in ({}, {b"abc": 256}):
        own = ranks | extra
        start, words = bpe.Start(own), ["xabcab", "axyzb", "abcd", "ab" * 20 + "cd", "cdcdabc", "a"]
        df = spark.createDataFrame([(w, start(w.encode())) for w in words], "word string, state array<bigint>")
        for r in bpe.encode_words(df, own).collect():
            assert list(r.ids) == bpe.merge_long(r.word.encode(), own), r.word


def test_bpe_tasks_that_forget_their_words(spark, monkeypatch):
    import tiktoken
    monkeypatch.setattr(bpe, "REMEMBERED", 40)
    monkeypatch.setattr(bpe, "SLICE_BYTES", 300)
    t = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(BYTE_BPE), special_tokens={})
    rnd = random.Random(14)
    words = ["".join(rnd.choice("abcdethé'1 ,") for _ in range(rnd.randint(1, 50))) for _ in range(300)]
    texts = {k: " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 20))) for k in range(400)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(2)
    got = bpe.encode_documents(docs, BYTE_BPE, P.PATTERN).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = t.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_bpe_words_of_letters_are_cut_without_the_pattern():
    """str.isalpha says no more than the pattern's letters; after clearing, codes count from 0."""
    import regex
    every = [chr(x) for x in [*range(0xD800), *range(0xE000, 0x110000)]]
    letters = set(regex.findall(r"\p{L}", "".join(every)))
    assert {x for x in every if x.isalpha()} <= letters
    codes = bpe.Codes(P.PATTERN)
    codes.find = lambda x: pytest.fail(x)
    codes.of("letters alone and ünïcödé 中文 letters")
    assert codes.new == ["letters", " alone", " and", " ünïcödé", " 中文", " letters"]
    codes.clear()
    assert codes.count == len(codes) == len(codes.words) == 0


def test_bpe_stretches_are_cut_as_whole_texts():
    import regex
    assert bpe.PUBLIC == P.PATTERN
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    assert regex.findall(r"\s", every) == bpe.re.findall(f"[{bpe.SPACES}]", every)
    rnd, find = random.Random(4), regex.compile(P.PATTERN).findall
    for text in ("".join(rnd.choice("  \n\t\x1c 　ab'sllé9٣.,!中\U0001f600") for _ in range(rnd.randint(0, 30))) for _ in range(20000)):
        codes = bpe.Codes(P.PATTERN)
        own = np.frombuffer(codes.of(text), np.int32)
        assert [codes.new[i] for i in own] == find(text), repr(text)
    codes = bpe.Codes(P.PATTERN)
    codes.of("many words, many more words")
    assert len(codes) == 5 and codes.of(" words, many") == codes[" words,"] + codes[" many"]  # cut once, then looked up
    start = bpe.Start(bpe.read_ranks(BYTE_BPE))
    words = [b"a", b"abc", b"", b"xyzzy"]
    rows = start.many([w for w in words if w], [bool(w) for w in words]).to_pylist()
    assert rows == [start(w) if w else None for w in words]
    assert start.many([], [False]).to_pylist() == [None]


def test_bpe_texts_are_cut_together():
    """Each distinct stretch of many texts is looked up once; nulls, empty texts and parts of arrays; other patterns."""
    import pyarrow as pa
    import regex
    asked = []

    class Counted(bpe.Codes):
        def __getitem__(self, stretch):
            asked.append(stretch)
            return super().__getitem__(stretch)

    codes = Counted(P.PATTERN)
    own = np.frombuffer(codes.of("the same word " * 1000), np.int32)
    assert [codes.new[i] for i in own] == regex.findall(P.PATTERN, "the same word " * 1000)
    assert collections.Counter(asked) == {"the": 1, " same": 1, " word": 1, " the": 1, " ": 1}
    rnd, chars = random.Random(15), "  \n\x85\xa0\u1680\u2003\u2029\u3000\u200bab'sé9.中\u3001\U0001f600"
    for pattern in (P.PATTERN, r"\w+|\W"):
        codes, find = bpe.Codes(pattern), regex.compile(pattern).findall
        for _ in range(300):
            texts = [rnd.choice([None, "", *["".join(rnd.choice(chars) for _ in range(rnd.randint(0, 12)))] * 6]) for _ in range(12)]
            for kind in (pa.string(), pa.large_string()):
                part = pa.array(texts, kind).slice(rnd.randint(0, 3), rnd.randint(0, 9))
                got = [[codes.new[i] for i in np.frombuffer(x, np.int32)] for x in codes.many(part).to_pylist()]
                assert got == [find(x or "") for x in part.to_pylist()]


def test_bpe_digests_of_pieces():
    import pyarrow as pa
    words = bpe.Pieces()
    empty = hashlib.sha256(b"").hexdigest()
    assert [x.to_pylist() for x in words.digests(pa.array([b""], pa.binary()))] == [[0], [empty], [empty]]
    for ids, decoded in (([[7], [70000, 1]], [b"a", b"\xff\x00"]), ([], []), ([[3, 4, 5]], [b" c"])):
        words.add(pa.RecordBatch.from_arrays([pa.array([[9], *ids], pa.list_(pa.int64())).slice(1), pa.array(decoded, pa.binary())], ["ids", "decoded"]))
    lists = pa.array([np.array(x, np.int32).tobytes() for x in ([1], [2, 0, 2], [], [1, 1])], pa.binary())
    tokens, shown, decoded = (x.to_pylist() for x in words.digests(lists.slice(1)))
    assert tokens == [7, 0, 4]
    assert shown == [hashlib.sha256(x).hexdigest() for x in (b"3 4 5 7 3 4 5", b"", b"70000 1 70000 1")]
    assert decoded == [hashlib.sha256(x).hexdigest() for x in (b" ca c", b"", b"\xff\x00\xff\x00")]


def test_shards(spark, odd):
    out = sharding.histogram_shards(odd)
    assert out.count() == odd.count()
    for r in out.groupBy("shard").agg(F.sort_array(F.collect_list("slot")).alias("s")).collect():
        assert r.s == list(range(len(r.s)))
    assert sharding.histogram_shards(odd.limit(0)).count() == 0


@pytest.mark.parametrize("slice_rows", [200_000, 40])
def test_shards_of_a_hot_text_stay_near_equal(spark, slice_rows):
    rnd = random.Random(2)
    rows = [(i, "the same text again " * 8 if i % 3 == 0 else "x" * rnd.randint(0, 300)) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.histogram_shards(docs, rows_per_slice=slice_rows).collect()
    size, slots = collections.Counter(), collections.defaultdict(list)
    for r in got:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    mean = sum(size.values()) / 24
    assert len(size) == 24 and max(abs(v - mean) for v in size.values()) < 0.02 * mean
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    texts = dict(rows)
    where = collections.defaultdict(set)
    for r in got:
        where[texts[r.doc_id]].add(r.shard)
    hot = where.pop("the same text again " * 8)
    assert len(hot) == max(hot) - min(hot) + 1  # equal texts lie together: in neighbouring shards
    plan = sharding.histogram_shards(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExistingRDD"))


def test_stages_on_odd_rows(spark, odd, scratch):
    sf = "/root/testdata/sf0.001"
    for stage in (stages.quality, stages.near_duplicates, stages.drop_contaminated, stages.redact_secrets):
        assert stage(spark, odd, sf).columns == odd.columns
        assert stage(spark, odd.limit(0), sf).count() == 0
    coded = stages.encode(spark, odd, sf)
    assert sorted((r.doc_id or 0, r.n_tokens == 0) for r in coded.collect()) == sorted(
        (r.doc_id or 0, not r.text) for r in odd.collect())
    assert stages.encode(spark, odd.limit(0), sf).count() == 0
    assert stages.quality(spark, odd.union(odd), sf).count() == 2 * stages.quality(spark, odd, sf).count()
    kept = stages.near_duplicates(spark, odd, sf)
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [1, 2, 3, 5, 7, 8, 10] and kept.where("doc_id is null").count() == 2
    assert stages.drop_contaminated(spark, odd, sf).count() == stages.redact_secrets(spark, odd, sf).count() == odd.count()
    dirty = spark.createDataFrame([(1, "key: AKIA" + "B" * 16 + " end", 27), (2, "clean", 5), (3, None, None)], "doc_id long, text string, n_chars long")
    out = {r.doc_id: (r.text, r.n_chars) for r in stages.redact_secrets(spark, dirty, sf).collect()}
    assert out == {1: ("key: [secret] end", 17), 2: ("clean", 5), 3: (None, None)}


MIXED = ["", "Don't 'S. it's, a.b .", "<|endoftext|> x<|endoftext|>.y <|x|>", "\u0130 I. \u017f \u0149 \u00c9t\u00e9, \u1e9e \u00c5", "e\u0301 \u0301a x\u00a0y \u3000 \x85z",
         "\x00\x01\x1c q", "12, 3. \u4e2d\u6587 \U0001f600\U0001f600 \u00bd", "a" * 400, "  two  spaces\n\tand lines \r\n", "\u2581 mark", "<0x41> <s> </s> <unk>", " "]


def test_automaton_on_odd_rows(spark, odd):
    out = tokenization_automaton.code_digests(tokenization_automaton.code_documents(odd, WORD_BPE))
    got = collections.Counter((r.doc_id, r.n_tokens) for r in out.collect())
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(WORD_BPE)
    assert got == collections.Counter((r.doc_id, len(t.encode(r.text or "", add_special_tokens=False).ids)) for r in odd.collect())
    assert tokenization_automaton.code_documents(odd.limit(0), WORD_BPE).count() == 0
    with pytest.raises(ValueError):
        tokenization_automaton.compile_tokenizer(P.path("byte_bpe_50k.json"))


def test_automaton_equals_the_library():
    from tokenizers import Tokenizer
    t, rnd = Tokenizer.from_file(WORD_BPE), random.Random(11)
    coder = tokenization_automaton.Coder(WORD_BPE, *tokenization_automaton.compile_tokenizer(WORD_BPE))
    texts = MIXED + ["".join(rnd.choice("aeTh\u00e9\u00c0.,'s1 \u01c5\u0130\u00df\u03a9\u4e2d\u00ad") for _ in range(12)) for _ in range(2000)]
    texts += ["".join(rnd.choice("thein") for _ in range(rnd.randint(1, 90))) for _ in range(1500)]
    for x, ids in zip(texts, coder.encode(texts)):
        want = t.encode(x, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, x
        assert coder.decode(ids) == t.decode(want, skip_special_tokens=False)


def test_gadgets_against_merging_in_turn():
    """Random merge lists, some useless and some of a symbol with itself, against merging pair after pair."""
    rnd = random.Random(12)
    for _ in range(150):
        symbols = ["a", "b", "c", "a</w>", "b</w>", "c</w>"]
        merges, made = [], set(symbols)
        for _ in range(rnd.randint(1, 14)):
            u, v = rnd.choice([x for x in made if not x.endswith("</w>")]), rnd.choice(sorted(made))
            if u + v not in made:
                merges.append((u, v))
                made.add(u + v)
            made = set(sorted(made))
        vocabulary = {x: i for i, x in enumerate(sorted(made))}
        machine = tokenization_automaton.Automaton(vocabulary, merges)
        words = ["".join(rnd.choice("abc" if rnd.random() < 0.7 else "a") for _ in range(rnd.randint(1, 12))) for _ in range(40)]
        for w, ids in zip(words, machine.paths([x.encode() for x in words])):
            tokens = [*w[:-1], w[-1] + "</w>"]
            for u, v in merges:
                out = []
                for x in tokens:
                    if out and out[-1] == u and x == v:
                        out[-1] = u + v + "\0"  # made in this turn: not merged again
                    else:
                        out.append(x)
                tokens = [x.rstrip("\0") for x in out]
            want = [vocabulary[x] for x in tokens]
            assert np.frombuffer(ids, "<u4").tolist() == machine.path(w.encode()) == want, (w, merges)


def test_alignment_on_odd_rows(spark, odd):
    a, b = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
    texts = dict(enumerate(MIXED + [r.text for r in odd.collect()]))
    docs = spark.createDataFrame([(d, x, 1, 2, "c") for d, x in texts.items()], "doc_id long, text string, chunk int, place int, pair string")
    got = sorted(tuple(r) for r in token_alignment.alignment_counts(docs.repartition(3), a, b).collect())
    assert got == sorted(brute_counts(brute_alignments(texts)))
    assert token_alignment.alignment_counts(odd, a, b).count() == odd.count()
    assert token_alignment.alignment_counts(odd.limit(0), a, b).count() == 0


def test_alignment_in_many_chunks(spark, tables, monkeypatch):
    monkeypatch.setattr(token_alignment, "CHUNK_LINKS", 1)  # a chunk for each slice
    monkeypatch.setattr("tidewater.llm.common.STEP_BYTES", 2000)
    a, b = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
    docs = spark.createDataFrame(sorted(tables.items()), "doc_id long, text string").repartition(5)
    assert sorted(tuple(r) for r in token_alignment.alignment_counts(docs, a, b).collect()) == sorted(brute_counts(brute_alignments(tables)))


def test_aligned_groups_and_overlaps(spark):
    a, b = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
    docs = spark.createDataFrame(list(enumerate(MIXED)), "doc_id long, text string")
    aligner = token_alignment.Aligner(a, b)
    for r in token_alignment.align_documents(docs, a, b).collect():
        if not r.a_ids:
            continue
        ends = [np.cumsum([len(t.bytes[i]) for i in ids]).tolist() for t, ids in ((aligner.a, r.a_ids), (aligner.b, r.b_ids))]
        assert [ends[0][i] for i in r.cut_a] == [ends[1][i] for i in r.cut_b] == sorted(set(ends[0]) & set(ends[1]))
        short, long = ends if r.by_a else ends[::-1]
        for k, (x, y) in enumerate(zip(r.overlap_from, r.overlap_to)):
            start, end = short[k - 1] if k else 0, short[k]
            assert list(range(x, y + 1)) == [m for m in range(len(long)) if long[m] > start and (long[m - 1] if m else 0) < end]


def test_galloping_ranks():
    rnd = random.Random(13)
    for _ in range(300):
        long = sorted(rnd.sample(range(5000), rnd.randint(1, 400)))
        short = sorted(rnd.sample(range(long[-1] + 1), min(long[-1], rnd.randint(0, 60)))) + [long[-1]]
        assert token_alignment.ranks_in(short, long) == np.searchsorted(long, short).tolist()


def test_splitters_agree_below_the_limit():
    quick, library = (lambda t: (t.quick, t.library))(token_alignment.ByteLevel(P.path("byte_bpe_50k.json")))
    for c in map(chr, range(ord(token_alignment.AGREED))):
        for x in (f" a{c}b", f" {c}{c} 1{c}", f"x {c}", f"{c}  {c}"):
            assert quick.encode_ordinary(x) == library.encode(x, add_special_tokens=False).ids, hex(ord(c))


def test_periodic_runs_on_odd_rows(spark, odd):
    digests = periodic_runs.run_digests(periodic_runs.periodic_runs(odd))
    got = collections.Counter(tuple(r) for r in digests.collect())
    assert got == collections.Counter((r.doc_id, *run_row((r.text or "").encode().split())) for r in odd.collect())
    assert periodic_runs.periodic_runs(odd.limit(0)).count() == 0
    assert periodic_runs.with_periods(odd).count() == odd.count()
    kept = {r.doc_id: r.text for r in periodic_runs.with_periods(spark.createDataFrame([(None, "a b c")], "doc_id long, text string")).collect()}
    assert kept == {None: "a b c"}


def test_periodic_runs_against_every_lag():
    rnd = random.Random(14)
    texts = []
    for _ in range(400):
        letters, w = rnd.choice([1, 2, 2, 3, 5, 50]), []
        for _ in range(rnd.randint(0, 5)):
            w += [f"w{rnd.randrange(letters)}" for _ in range(rnd.randint(1, 20))]
            block = w[-rnd.randint(1, min(len(w), 40)):] if rnd.random() < 0.5 else [f"w{rnd.randrange(letters)}" for _ in range(rnd.randint(1, 30))]
            w += (block * rnd.randint(2, 9))[:rnd.randint(10, 150)]
        texts.append(" ".join(w))
    split, codes, first = periodic_runs.word_codes(texts)  # all texts together, as in a slice
    at, lag = periodic_runs.diagonal_starts(codes, max(map(len, split)))
    for k, w in enumerate(split):
        own = (at >= first[k]) & (at < first[k + 1])
        runs = periodic_runs.online_runs(w, zip((at[own] - first[k]).tolist(), lag[own].tolist()))
        assert (len(runs), hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest()) == (run_row(w)[0], run_row(w)[5])


def test_periodic_runs_of_one_word_and_of_runs_in_runs():
    for w, want in ((["a"] * 100_000, [(0, 100_000, 1)]), ((["a"] * 300 + ["b"]) * 100, None)):
        _, codes, _ = periodic_runs.word_codes([" ".join(w)])
        at, lag = periodic_runs.diagonal_starts(codes, len(w))
        assert len(at) < 3 * len(w)
        runs = periodic_runs.online_runs(w, zip(at.tolist(), lag.tolist()))
        assert runs == (want or [(0, 300, 1), (0, 30_100, 301)] + [(301 * k, 300, 1) for k in range(1, 100)])
