"""SimHash, packing, quality rules, mixing and license scans against plain versions."""

import zlib
from collections import Counter, defaultdict

import brute
import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ontime.llm import licenses, mixing, packing, quality, queries, simhash

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(folder):
    return duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{folder}/documents.parquet'").fetchall()


# -- SimHash


def expected_components(rows):
    prints = [brute.simhash(r[1]) for r in rows]
    roots = brute.components(set(prints), lambda a, b: (a ^ b).bit_count() <= 2)
    named = defaultdict(list)
    for r, p in zip(rows, prints):
        named[roots[p]].append(r[0])
    first = {k: min((i for i in v if i is not None), default=None) for k, v in named.items()}
    return Counter((r[0], "%016x" % p, first[roots[p]]) for r, p in zip(rows, prints))


def test_simhash_query_equals_brute_force(spark, folder, docs):
    got = Counter(tuple(r) for r in queries.op3_simhash_near_dedup(spark, folder).collect())
    assert got == expected_components(docs)


def test_simhash_takes_odd_rows(spark):
    found = simhash.near_duplicates(brute.odd_docs(spark))
    got = Counter((r.id, r.hex, r.component_id) for r in found.withColumn("hex", simhash.hex_digits(F.col("fp"))).collect())
    assert got == expected_components(brute.ROWS)
    assert simhash.near_duplicates(brute.odd_docs(spark, [])).count() == 0


def test_large_buckets_link_exactly(spark, monkeypatch):
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 1 << 63, 4, np.uint64)
    values = set()
    for c in centres:
        for _ in range(150):  # chains of near copies: most pairs share a bucket, not all are within two bits
            flips = rng.choice(64, rng.integers(0, 5), replace=False)
            values.add(int(c) ^ sum(1 << int(b) for b in flips))
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame([(i, s) for i, s in enumerate(signed)], "id bigint, fp bigint")
    got = {r.fp: r.component_id for r in simhash.components_of(prints).collect()}
    roots = brute.components(values, lambda a, b: (a ^ b).bit_count() <= 2)
    first = {}
    for i, v in enumerate(values):
        first.setdefault(roots[v], i)
    assert got == {s: first[roots[v]] for s, v in zip(signed, values)}


def test_thresholds_catch_every_pair(spark):
    costs = [[0, 5, 9, 20], [0, 1, 3, 9], [0, 2, 8, 9]]
    cost, chosen = simhash.allot(costs, 0)
    assert sum(chosen) == 0 and cost == min(
        costs[0][a + 1] + costs[1][b + 1] + costs[2][c + 1]
        for a in range(-1, 3) for b in range(-1, 3) for c in range(-1, 3) if a + b + c == 0
    )


def test_correlated_bits_share_a_group():
    rng = np.random.default_rng(0)
    bits = rng.integers(0, 2, (2000, 64))
    for k in range(1, 8):
        bits[:, 8 * k] = bits[:, 0]  # eight copies of one bit
    groups = simhash.correlated_groups((bits.T @ bits).astype(float), 2000, 3)
    assert sorted(b for g in groups for b in g) == list(range(64))
    assert any(set(range(0, 64, 8)) <= set(g) for g in groups)


def test_keep_one_leaves_one_of_each_group(spark):
    kept = simhash.keep_one(brute.odd_docs(spark))
    assert kept.columns == brute.odd_docs(spark).columns
    rows = kept.collect()
    names = {c for _, _, c in expected_components(brute.ROWS)}
    assert Counter(r.doc_id for r in rows) == Counter(names)
    assert simhash.keep_one(brute.odd_docs(spark, [])).count() == 0


# -- packing


def check_pieces(rows, pieces, window=4096):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    ids = [tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2] for r in rows]
    whole = Counter((r[0], zlib.crc32(np.array(x, "<u4").tobytes())) for r, x in zip(rows, ids))
    sequences = defaultdict(dict)
    for p in pieces:
        assert p.offset not in sequences[p.sequence_id]
        sequences[p.sequence_id][p.offset] = p
    stream, got, open_ids = [], Counter(), b""
    for s in sorted(sequences):
        at = 0
        for offset in sorted(sequences[s]):
            p = sequences[s][offset]
            assert offset == at and len(p.ids) == 4 * p.length and p.start * 4 == len(open_ids)
            at += p.length
            open_ids += bytes(p.ids)
            if p.start + p.length == p.doc_tokens:
                got[p.id, zlib.crc32(open_ids)] += 1
                open_ids = b""
        stream.append(at)
    assert got == whole
    assert all(x == window for x in stream[:-1]) and sorted(sequences) == list(range(len(stream)))


@pytest.mark.parametrize("parts, window", [(1, 4096), (3, 64)])
def test_packing_takes_odd_rows(spark, parts, window):
    docs = brute.odd_docs(spark).repartition(parts)
    check_pieces(brute.ROWS, packing.pack(docs, TOKENIZER, window=window).collect(), window)


def test_packing_query_equals_tokenizer(spark, folder, docs):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    check_pieces(docs, packing.pack(table, TOKENIZER).collect())
    assert queries.op4_packing(spark, folder).columns == [
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    ]
    assert packing.pack(brute.odd_docs(spark, []), TOKENIZER).count() == 0


# -- quality


def test_base_statistics(spark, folder, docs):
    rows = [r[:4] for r in docs] + [r[:4] for r in brute.ROWS]
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    found = quality.statistics(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string"))
    got = Counter((r.doc_id, *(r[c] for c in columns)) for r in found.collect())
    assert got == Counter((r[0], *brute.base_statistics(r[1])) for r in rows)


def numpy_verdicts(rows):
    """The estimates with numpy: same starts, bins and pull; Cholesky by numpy."""
    x, groups = [], []
    for doc_id, text, lang, source, *_ in rows:
        n, chars, symbols, lines, repeats, failed = brute.base_statistics(text)
        if failed:
            continue
        m = max(n, 1)
        values = [np.log1p(n), np.log1p(chars / m), (100 * symbols / m) ** 0.5, (100 * (repeats + lines) / m) ** 0.5]
        x.append([np.floor(v * quality.UNIT + 0.5) / quality.UNIT for v in values])
        groups.append((lang, source))
    x = np.array(x)
    member = {g: np.array([h == g for h in groups]) for g in set(groups)}
    floors = np.array([f for _, f in quality.COORDINATES])

    def estimate(core, inflate):
        every = core.any(axis=0) if core.ndim > 1 else core
        total = np.cov(x[every].T, bias=True)
        out = {}
        for g, own in member.items():
            rows_in = x[own & every]
            w = len(rows_in) / (len(rows_in) + quality.PRIOR_ROWS)
            cov = (w * np.cov(rows_in.T, bias=True).reshape(total.shape) + (1 - w) * total) * inflate + np.diag(floors**2)
            out[g] = w * rows_in.mean(axis=0) + (1 - w) * x[every].mean(axis=0), np.linalg.cholesky(cov)
        return out

    def distances(found):
        d2 = np.zeros(len(x))
        for g, own in member.items():
            centre, factor = found[g]
            d2[own] = (np.linalg.solve(factor, (x[own] - centre).T) ** 2).sum(axis=0)
        return d2

    def medians():
        out = {}
        for g, own in member.items():
            v = np.floor(x[own] * quality.UNIT / 16).astype(int)
            quarter = [np.sort(v, axis=0)[int(np.ceil(q * len(v))) - 1] * 16 / quality.UNIT for q in (0.25, 0.5, 0.75)]
            out[g] = quarter[1], np.diag(np.sqrt(((quarter[2] - quarter[0]) / 1.349) ** 2 + floors**2))
        return out

    ends = {}
    for start, found in (("mean", estimate(np.ones(len(x), bool), 1.0)), ("median", medians())):
        for _ in range(quality.ROUNDS):
            d2 = distances(found)
            bins = np.floor(np.log2(np.maximum(d2, 2.0**-20)) * quality.BINS_PER_DOUBLING)
            core = np.zeros(len(x), bool)
            for own in member.values():
                limit = np.sort(bins[own])[int(np.ceil(quality.CORE_SHARE * own.sum())) - 1]
                core |= own & (bins <= limit)
            found = estimate(core, quality.CONSISTENCY)
        ends[start] = found
    best = {
        g: min((np.log(np.diag(e[g][1])).sum(), s) for s, e in ends.items())[1] for g in member
    }
    return distances({g: ends[s][g] for g, s in best.items()})


def test_robust_distances_equal_numpy(spark, folder, docs):
    table = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string")
    # Two sources and all languages, so that groups are of very different sizes.
    table = table.withColumn("source", F.when(F.col("doc_id") % 10 < 7, "hot"))
    rows = [(d, t, lang, "hot" if d % 10 < 7 else None) for d, t, lang, _ in docs]
    found = {r.doc_id: r for r in quality.judge(table).collect()}
    expected = iter(numpy_verdicts(rows))
    for row in rows:
        got = found[row[0]]
        if got.base_failed:
            assert not got.kept
        else:
            d2 = next(expected)
            assert got.d2 == pytest.approx(d2, rel=1e-6)
            assert got.kept == (d2 <= quality.LIMIT)


def test_planted_outliers_go_and_clean_documents_stay(spark):
    rng = np.random.default_rng(3)
    vocabulary = ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) for _ in range(3000)]
    clean = [" ".join(rng.choice(vocabulary, rng.integers(80, 900))) + "." for _ in range(160)]
    junk = ["".join(w + "###$$$ " for w in rng.choice(vocabulary, 200)) for _ in range(12)]
    rows = [(i, t, "en", "s", 0, None) for i, t in enumerate(clean + junk)]
    kept = {r.doc_id for r in quality.keep_good(brute.odd_docs(spark, rows)).collect()}
    assert kept == set(range(160))


def test_quality_takes_odd_rows(spark):
    found = quality.judge(brute.odd_docs(spark))
    assert found.count() == len(brute.ROWS)
    assert quality.keep_good(brute.odd_docs(spark)).columns == brute.odd_docs(spark).columns
    assert {r.doc_id for r in quality.keep_good(brute.odd_docs(spark)).collect()} <= {8, 9}
    assert quality.judge(brute.odd_docs(spark, [])).count() == 0


def test_core_share_constants():
    # Known values: the median and the 95 % point of chi-square with 4 degrees of freedom.
    assert quality.chi_square_point(0.5, 4) == pytest.approx(3.3567, abs=1e-4)
    assert quality.chi_square_point(0.05, 4) == pytest.approx(9.4877, abs=1e-4)


# -- mixing


def test_targets_fill_up(spark):
    sizes = {"a": 100, "b": 1000, "c": 10, None: 50, "d": 0}
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    weights = dict(zip(["a", "b", "c", "d", None], [3, 1, 2, 3, 1]))
    target, open_sources, left = {}, set(sizes), 1.5 * sum(sizes.values())
    while True:  # share again by weight until none is above
        share = {s: left * weights[s] / sum(weights[o] for o in open_sources) for s in open_sources}
        full = {s for s in open_sources if share[s] > 2 * sizes[s]}
        if not full:
            target |= share
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_sources -= full
        if not open_sources:
            break
    assert got == pytest.approx(target)


def test_mix_equals_sql_and_comes_near(spark, folder):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    relation = connection.sql(mixing.SQL)
    got = queries.op10_source_mix(spark, folder)
    assert Counter(tuple(r[c] for c in relation.columns) for r in got.collect()) == Counter(relation.fetchall())


def test_mix_takes_odd_rows(spark):
    docs = brute.odd_docs(spark)
    rows = mixing.mix_report(docs).collect()
    assert len(rows) == len(brute.ROWS) and all(r.taken <= 2 * r["size"] for r in rows)
    assert Counter(map(tuple, rows)) == Counter(map(tuple, mixing.mix_report(docs.repartition(5)).collect()))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert sum(len(brute.words(r.text)) for r in mixed.collect()) == sum(r.taken for r in rows)
    assert mixing.mix(brute.odd_docs(spark, [])).count() == 0


# -- licenses


def test_license_scan_equals_containment(spark, folder, docs):
    texts = {d: t for d, t, *_ in docs}
    library = licenses.Library(licenses.TEMPLATES)
    expected = set()
    for d, text in texts.items():
        own = licenses.shingles(licenses.normal_words((text or "").encode()))
        for name, wanted in library.exact.items():
            span = 2 * len(wanted)
            if len(wanted.intersection(own)) >= 0.8 * len(wanted) and any(
                len(wanted.intersection(own[i : i + span])) >= 0.8 * len(wanted) for i in range(len(own))
            ):
                expected.add((d, name))
    assert {(r.doc_id, r.license) for r in queries.op7_license_scan(spark, folder).collect()} == expected


def test_planted_licenses_are_found(spark):
    rng = np.random.default_rng(0)
    filler = lambda n: " ".join(f"w{k}" for k in rng.integers(0, 10_000, n))
    rows, expected = [], set()
    for i, (name, text) in enumerate(licenses.TEMPLATES.items()):
        words = text.split()
        changed = list(words)
        if len(words) > 60:
            changed[len(words) // 2] = "other"  # five of its shingles are lost
        shouted = " ".join(changed).upper()
        rows.append((i, f"{filler(rng.integers(0, 400))} {shouted}\n{filler(40)}", "en", "a", 0, None))
        expected.add((i, name))
        rows.append((1000 + i, " ".join(words[: len(words) // 2]) + " " + filler(100), "en", "a", 0, None))
    found = {(r.id, r.license) for r in licenses.scan(brute.odd_docs(spark, rows)).collect()}
    assert expected <= found
    assert not {f for f in found if f[0] >= 1000 and len(licenses.TEMPLATES[f[1]].split()) > 60}


def test_license_scan_takes_odd_rows(spark):
    assert licenses.scan(brute.odd_docs(spark)).count() == 0
    assert licenses.scan(brute.odd_docs(spark, [])).count() == 0
    with pytest.raises(ValueError):
        licenses.Library({"short": "too short"})
