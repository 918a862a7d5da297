"""Spelling variants, SimHash components and hard negatives against brute force."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lakeward.llm import hard_negatives, simhash, spelling
from lakeward.llm.graph import components
from lakeward.llm.scores import LEAST, MOST, as_long, beyond, restored

SCHEMA = "doc_id long, text string, word string, n long, fp long, label string, id long, key string"


def docs_of(spark, texts):
    """Documents with further columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "w", 1, 2, "l", 3, "k") for i, t in texts], SCHEMA)


# -- spelling -----------------------------------------------------------------------------------------------------------


def brute_words(texts):
    out = Counter()
    for i, t in texts:
        run = ""
        for c in (t or "") + " ":
            if "a" <= c.lower() <= "z" and c.isascii() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
            elif run:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                if h % 31 == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
                out[run] += 1
                run = ""
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()}


def test_rotations_meet_exactly_for_near_words():
    rng = random.Random(1)
    words = {"".join(rng.choice("abà") for _ in range(rng.randint(1, 6))) for _ in range(150)}
    for long in (spelling.LONG, 3):
        ranges = defaultdict(list)
        for w in words:
            for key, kind in spelling.rotations(w, long):
                ranges[key].append((w, kind))
        met = Counter()
        for members in ranges.values():
            assert sum(kind == spelling.WHOLE for _, kind in members) <= 1
            assert len({w for w, _ in members}) == len(members)
            for w, k in members:
                for v, j in members:
                    if w < v:
                        assert one_edit(w, v)
                        met[w, v] += not (spelling.SKIP_OTHER in (k, j) and spelling.WHOLE in (k, j))
        assert met == {(w, v): 1 for w in words for v in words if w < v and one_edit(w, v)}


def test_spelling_variants(spark):
    rng = random.Random(3)
    base = ["reading", "readings", "spreading", "straßen", "ÉCOLIERS", "écoliers", "aaaaaaa", "aaaaaaaa", "matters", "masters", "batters"]
    long = "ab" * 300 + "c"  # its keys are digests
    base += [long, long[:300] + long[301:], long + "d", "x" * spelling.LONG, "x" * (spelling.LONG + 1), "x" * (spelling.LONG + 2)]
    texts = []
    for i in range(260):
        words = [rng.choice(base[:11]) if rng.random() < 0.8 else rng.choice(base) for _ in range(12)] + ["commonest"] * 30
        words += [w[:k] + w[k + 1:] for w in words[:3] for k in (rng.randrange(len(w)),)]
        texts.append((i, rng.choice([" ", ", ", "1"]).join(words)))
    texts += [(300, None), (301, ""), (None, "readers reading"), (None, "readers reading"), (1, texts[1][1]), (302, "X" * 5000 + " " + "x" * 5000)]
    counts = brute_words(texts)
    assert any(len(w) > 500 for w in counts)
    words = spelling.word_counts(docs_of(spark, texts), typo_every=31)
    assert {r.word: r.n for r in words.collect()} == counts
    got = spelling.spelling_variants(words)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(counts) and set(rows) == brute_variants(counts)
    assert any(f is not None and f != r for _, f, r, *_ in rows) or any(f for _, f, *_ in rows)


def test_spelling_chains_and_ties(spark):
    counts = {"abcdefg": 1, "abcdefgh": 10, "abcdefghi": 100, "abcdefghij": 1000, "zbcdefg": 10, "lonely-word": 5, "éèêëàùç": 7}
    frame = spark.createDataFrame([(w, n, "clash") for w, n in counts.items()], "word string, n long, key string")
    rows = {tuple(r) for r in spelling.spelling_variants(frame).collect()}
    assert rows == brute_variants(counts)
    assert ("abcdefg", "abcdefgh", "abcdefghij", 1, 2, 10) in rows  # equal counts: the first in code-point order


def test_spelling_empty(spark):
    assert spelling.spelling_variants(spelling.word_counts(docs_of(spark, []), typo_every=31)).collect() == []
    assert spelling.spelling_variants(spelling.word_counts(docs_of(spark, [(1, None), (2, "short ones")]))).collect() == []


# -- SimHash ------------------------------------------------------------------------------------------------------------


def brute_fingerprint(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").translate(
        {c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, max_bits=4):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= max_bits:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def grouping(labels):
    groups = defaultdict(set)
    for k, x in enumerate(labels):
        groups[x].add(k)
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("block", [simhash.BLOCK, 40])
def test_simhash_components(spark, block):
    rng = random.Random(5)
    vocab = [f"w{k}" for k in range(400)]
    texts = []
    for f in range(6):  # families of edited copies; the first is large
        words = [rng.choice(vocab) for _ in range(rng.choice([60, 150, 400]))]
        for _ in range(150 if f == 0 else 8):
            w = list(words)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            texts.append((len(texts) * 3, " ".join(w)))
    texts += [(2, None), (1, ""), (5, " \n\t"), (None, "é É Ab\tcd\x0bef gh"), (None, "only"), (9, "ONLY"), (4, "a b c d"), (0, texts[0][1])]
    texts += [(9001, " ".join(rng.choice(vocab) for _ in range(70_000)))]
    out = simhash.near_components(docs_of(spark, texts), block=block).collect()
    fps = [brute_fingerprint(t) for _, t in texts]
    want = brute_components(fps)
    least, size = {}, Counter(want)
    for (i, _), c in zip(texts, want):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    expected = Counter((i, f"{fp:016x}", least.get(c), size[c]) for (i, _), fp, c in zip(texts, fps, want))
    assert Counter(tuple(r) for r in out) == expected
    assert simhash.near_components(docs_of(spark, [])).collect() == []


@pytest.mark.parametrize("block", [simhash.BLOCK, 16])
def test_simhash_links_of_planted_bits(spark, block):
    """Links of all kinds of four bits, a dense ball, chains and a crowd that shares a segment; tiles change nothing."""
    rng = random.Random(11)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for x in list(fps[:40]):
        for _ in range(3):
            y = x
            for b in rng.sample(range(64), rng.choice([3, 4, 4, 5])):
                y ^= 1 << b
            fps.append(y)
    ball = rng.getrandbits(64)
    fps += [ball ^ (1 << a) ^ (1 << b) for a in range(0, 64, 5) for b in range(1, 64, 9)]
    chain = rng.getrandbits(64)
    for k in range(0, 60, 4):
        chain ^= 0b1111 << k
        fps.append(chain)
    fps += [(0xABCDE << 44) | rng.getrandbits(43) for _ in range(120)]
    fps = sorted(set(fps))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    parts = simhash.segments()
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    links = simhash._links(simhash._rows(frame, parts, block), simhash.MAX_BITS, parts)
    pairs = [(int(a), int(b)) for a, b in links.collect()]
    assert all(((a ^ b) % (1 << 64)).bit_count() <= 4 and a != b for a, b in pairs)
    assert len(set(map(frozenset, pairs))) == len(pairs)
    label = {r.node: r.label for r in components(links).collect()}
    assert grouping(brute_components(fps)) == grouping([label.get(x, x) for x in signed])


def test_simhash_segments():
    with pytest.raises(ValueError):
        simhash.near_components(None, max_bits=6, n_segments=3)


# -- hard negatives -----------------------------------------------------------------------------------------------------


def brute_negatives(rows, every, positives=5, negatives=3, scale=256):
    found = {}
    for i, vec, label, *_ in rows:
        ok = i is not None and label is not None and vec is not None and all(x is not None and np.isfinite(x) for x in vec)
        if ok and (i not in found or (label, vec) < found[i]):
            found[i] = (label, vec)

    def whole(x):
        n, d = float(x).as_integer_ratio()
        return scale * n // d

    found = {i: (label, [whole(x) for x in vec]) for i, (label, vec) in found.items()}
    out = set()
    for a, (label, q) in found.items():
        if a % every:
            continue
        score = {i: sum(x * y for x, y in zip(q, v)) for i, (_, v) in found.items() if i != a and len(v) == len(q)}
        of = sorted((i for i in score if found[i][0] == label), key=lambda i: (-score[i], i))[:positives]
        for p in of:
            inside = [i for i in score if found[i][0] != label and 50 * score[p] <= 100 * score[i] <= 95 * score[p]]
            for rank, i in enumerate(sorted(inside, key=lambda i: (-score[i], i))[:negatives], 1):
                out.add((a, p, rank, i, as_long(score[p]), as_long(score[i])))
    return out


VECTORS = "vec_id long, embedding array<double>, label int, angles string, norm string, size string, block string"


def vectors_of(spark, rows):
    return spark.createDataFrame([(*r, "a", "n", "s", "b") for r in rows], VECTORS)


@pytest.mark.parametrize("sizes", [(4096, 4096), (7, 13)])
def test_hard_negatives(spark, monkeypatch, sizes):
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", sizes[0])
    monkeypatch.setattr(hard_negatives, "SHARD_ROWS", sizes[1])
    rng = np.random.default_rng(2)
    rows = []
    for i in range(260):
        centre = np.random.default_rng(i % 9).standard_normal(8)
        v = centre + rng.standard_normal(8) * rng.choice([0.05, 0.6])
        rows.append((i, [float(x) for x in v * rng.choice([1.0, 0.2, 40.0])], int(rng.integers(0, 4)) if i % 3 else 1))
    rows += [(300 + i, rows[i][1], (rows[i][2] + i) % 3) for i in range(60)]  # ties
    rows += [(400, None, 1), (405, [1.0, None], 1), (410, [float("nan")] * 8, 1), (415, [float("inf")] * 8, 1), (420, [1.0] * 8, None),
             (None, [1.0] * 8, 1), (425, [0.0] * 8, 1), (430, [], 1), (435, [], 2), (440, [], 1), (445, [1.0, 2.0], 1), (450, [1.0, 1.0], 1),
             (451, [0.5, 1.0], 2), (5, rows[5][1], 0), (10, [9.0] * 8, 3), (10, [9.0] * 8, 3)]
    got = [tuple(r) for r in hard_negatives.hard_negatives(vectors_of(spark, rows), F.col("vec_id") % 5 == 0).collect()]
    want = brute_negatives(rows, 5)
    assert len(got) == len(want) and set(got) == want and len({a for a, *_ in got}) > 30


def test_hard_negatives_of_huge_components(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.uniform(0.5, 1.0, 4) * 10.0 ** rng.choice([0, 9, 20, 160, 306])], int(i % 3)) for i in range(90)]
    got = {tuple(r) for r in hard_negatives.hard_negatives(vectors_of(spark, rows), F.col("vec_id") % 2 == 0).collect()}
    assert got == brute_negatives(rows, 2) and any(r[4] == MOST for r in got)


def test_hard_negatives_with_a_repeated_hot_row(spark):
    """A third of the rows repeat one id, another third share a vector and a label."""
    rng = np.random.default_rng(8)
    vec = lambda: [float(x) for x in rng.standard_normal(6)]
    one, other = vec(), vec()
    rows = [(7, one, 1)] * 100 + [(1000 + i, other, 2) for i in range(100)] + [(i, vec(), int(i % 3)) for i in range(20, 120)]
    got = [tuple(r) for r in hard_negatives.hard_negatives(vectors_of(spark, rows), F.col("vec_id") % 10 == 0).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_negatives(rows, 10)
    assert hard_negatives.hard_negatives(vectors_of(spark, []), F.col("vec_id") % 10 == 0).collect() == []


def test_bounds_hold_and_select():
    """Bounds enclose every integer score, and most pairs of vectors near a direction need none."""
    rng = np.random.default_rng(0)
    for size in (1, 2, 16, 64):
        d = hard_negatives.directions(size)
        x = np.concatenate([rng.standard_normal((150, size)), d + rng.standard_normal(d.shape) * 0.01, -d, d * 1e-3])
        made = [hard_negatives.angles_and_norm(v) for v in x]
        angles, norms = np.array([a for a, _ in made]), np.array([n for _, n in made])
        open_pairs, fixed = 0, hard_negatives.fixed_point(x)
        for v, a, n in zip(x, angles, norms):
            low, high = hard_negatives.bounds(a, n, angles.T, norms, size)
            scores = hard_negatives.exact_scores(hard_negatives.fixed_point(v), fixed, hard_negatives.largest(fixed))
            assert (low <= scores).all() and (scores <= high).all()
            open_pairs += int((high >= 0.9 * n * n).sum())
        assert size < 16 or open_pairs < 0.95 * len(x) ** 2


def test_scores_beyond_a_long():
    exact = [0, MOST, LEAST, MOST + 1, MOST + 2, MOST + 2**70, 2**900, 2**900 + 1, LEAST - 1, LEAST - 2, LEAST - 2**70, -(2**900), -(2**900) - 1]
    key = lambda n: (as_long(n), beyond(n) or "")
    assert sorted(exact) == sorted(exact, key=key)
    assert [restored(as_long(n), beyond(n)) for n in exact] == exact


def test_hard_negatives_sql(spark):
    import duckdb

    from lakeward.llm.oracle import ORACLE
    from lakeward.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    got = QUERIES["op13_hard_negatives"](spark, sf)
    want = con.execute(ORACLE["op13_hard_negatives"]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.to_numpy().tolist()))


# -- edges of earlier operators -----------------------------------------------------------------------------------------


def test_topk_of_huge_components(spark):
    from lakeward.llm import topk

    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.uniform(-1, 1, 3) * 10.0 ** rng.choice([0, 12, 16, 160, 306])], 1) for i in range(70)]
    rows += [(500 + i, rows[3][1], 1) for i in range(30)]
    df = vectors_of(spark, rows)
    got = [tuple(r) for r in topk.top_k(df, df.where("vec_id % 10 = 0"), query_block=3, shard_rows=8).collect()]
    whole = {i: [1024 * a // b for a, b in (float(x).as_integer_ratio() for x in v)] for i, v, _ in rows}
    want = []
    for q in (i for i in whole if i % 10 == 0):
        scores = sorted((-sum(x * y for x, y in zip(whole[q], v)), i) for i, v in whole.items() if i != q)
        want += [(q, k, i, as_long(-s)) for k, (s, i) in enumerate(scores[:10], 1)]
    assert sorted(got) == sorted(want) and any(r[3] == MOST for r in got)


def test_a_third_of_all_rows_repeated(spark):
    """Rows that repeat an id (NULL too) and a text are one before texts are cut, scanned or learnt from."""
    from lakeward.llm import exact_dedup, toxicity

    texts = [(None, "")] * 3000 + [(k, f"text {k}") for k in range(100)] + [(7, "text 7")] * 500 + [(900, "text 7")]
    got = exact_dedup.exact_duplicates(docs_of(spark, texts)).collect()
    assert len(got) == len(texts) and sum(r.kept for r in got) == 101
    assert exact_dedup.drop_exact_duplicates(docs_of(spark, texts)).count() == 101
    labels = spark.createDataFrame([(k, k % 2) for k in range(100)], "doc_id long, toxic int")
    model = toxicity.train(docs_of(spark, texts), labels, max_rows=60, bits=10, epochs=1)
    once = toxicity.train(docs_of(spark, [(k, f"text {k}") for k in range(100)]), labels, max_rows=60, bits=10, epochs=1)
    assert np.array_equal(model.weight, once.weight) and np.array_equal(model.idx, once.idx)


def test_weak_entity_tags_validate(spark):
    from lakeward.llm import warc

    row = lambda i, day, status, tag: (i, "http://a/b", f"2024-01-0{day}", status, [("ETag", tag)], "d" if status == warc.FULL else None)
    rows = [row(1, 1, warc.FULL, '"a"'), row(2, 2, warc.NOT_MODIFIED, 'W/"a"'), row(3, 3, warc.NOT_MODIFIED, '"b"'),
            row(4, 4, warc.FULL, 'W/"c"'), row(5, 5, warc.NOT_MODIFIED, '"c"'), row(6, 6, warc.NOT_MODIFIED, 'w/"c"')]
    df = spark.createDataFrame(rows, "record_id long, url string, ts string, status string, "
                                     "headers array<struct<name:string,value:string>>, payload_digest string")
    df = df.withColumn("ts", F.to_timestamp("ts"))
    got = {r.record_id: r.outcome for r in warc.resolve_revisits(df).collect()}
    assert got == {1: "full", 2: "resolved", 3: "mismatch", 4: "full", 5: "resolved", 6: "mismatch"}


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op2_warc_revisits", "op7_line_windows", "op8_exact_topk", "op9_secret_ledger", "op10_mixing"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    from lakeward.llm.oracle import ORACLE
    from lakeward.llm.queries import QUERIES
    from tools.oracle_check import digest

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got = QUERIES[name](spark, sf)
    cur = con.execute(ORACLE[name])
    columns, rows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(got.columns) == sorted(columns)
    assert digest(got.columns, [tuple(r) for r in got.collect()]) == digest(columns, rows)
