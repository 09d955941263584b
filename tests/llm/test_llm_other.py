"""Chat formatting, URL filters, embeddings, sharding and LM scoring against plain versions; the pipeline."""

import json
import math
import zlib
from collections import Counter, defaultdict

import brute
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ontime.llm import chat, embeddings, lm, packing, queries, sharding, urls
from ontime.llm.components import connected_components

# -- chat


def test_chat_query_equals_sql(spark, folder):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    relation = connection.sql(chat.SQL)
    got = queries.op1_chat_format(spark, folder)
    assert Counter(tuple(r[c] for c in relation.columns) for r in got.collect()) == Counter(relation.fetchall())


TURNS = [
    (1, 0, "user", r"<s>\<|end|>\\[INST] <"), (1, 1, "assistant", "<</SYS>>|[/INST]\\"), (1, 1, "assistant", None),
    (2, 0, None, ""), (3, None, "<|text|>", "é\n<|turn|>"), (3, 1, "assistant", "<\\|"), (None, 0, "user", "hi"),
]


def test_formatting_is_reversible(spark):
    turns = spark.createDataFrame(TURNS, "id bigint, turn bigint, role string, text string")
    rows = chat.format_chats(turns).withColumn("read", chat.parse_chats(F.col("formatted"))).collect()
    expected = defaultdict(list)
    for i, turn, role, text in TURNS:
        expected[i].append((-1 if turn is None else turn, role or "", text or ""))
    for r in rows:
        assert [tuple(t) for t in r.read] == [t[1:] for t in sorted(expected[r.id])]
        assert "".join(p.text for p in r.pieces) == r.formatted
        inner = [p.text for p in r.pieces if p.loss]
        assert not any(c in text for text in inner for c in chat.CONTROL)
    assert chat.format_chats(turns.limit(0)).count() == 0


def test_layouts_are_chosen_by_fingerprint(spark):
    records = [
        {"prompt": "q", "response": "a"}, {"response": "a", "prompt": "q", "id": 7}, {"prompt": "q", "completion": "a"},
        {"instruction": "do", "input": "", "output": "done"}, {"instruction": "do", "input": "it", "output": "done"},
        {"messages": [{"role": "system", "content": "s"}, {"content": "q", "role": "user", "name": "n"}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": None}]},
        {"prompt": "q", "messages": []}, {"other": 1}, [1, 2], {"turn": 3, "role": "user", "text": "t"},
    ]
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)] + [(50, None), (51, "not json"), (52, "{}")]
    found = {
        r.id: (r.layout, r.turns and [(t.turn, t.role, t.text) for t in r.turns])
        for r in chat.record_turns(spark.createDataFrame(rows, "id bigint, record string"), "id", "record").collect()
    }
    pair = [(0, "user", "q"), (1, "assistant", "a")]
    assert found[0] == found[1] == ("prompt_response", pair) and found[2] == ("prompt_completion", pair)
    assert found[3][1] == [(0, "user", "do"), (1, "assistant", "done")]
    assert found[4][1] == [(0, "user", "do\n\nit"), (1, "assistant", "done")]
    assert found[5] == ("messages", [(0, "system", "s"), (1, "user", "q")])
    assert found[6] == ("conversations", [(0, "user", "q"), (1, "assistant", None)])
    assert found[10] == ("turn", [(3, "user", "t")])
    assert all(found[i] == (None, None) for i in (7, 8, 9, 50, 51, 52))


def test_tables_are_turned_by_their_schema(spark):
    table = spark.createDataFrame([(1, "q", "a", 5)], "conv bigint, prompt string, response string, record int")
    assert [tuple(r) for r in chat.table_turns(table, "conv").orderBy("turn").collect()] == [
        (1, 0, "user", "q"), (1, 1, "assistant", "a")
    ]
    with pytest.raises(ValueError):
        chat.table_turns(table.drop("response"), "conv")


# -- URLs

URLS = [
    "http://Shop.EXAMPLE.org/es/9?x=1", "https://example.org/en/12", "http://a.example.org/en/2", "http://x.com/fr/#a",
    "ftp://x.com/de/1", "http://x.com/d", "no scheme org/", None, "http://org", "http://org/", "http://borg/", "://",
    "http://h?q/de/", "a://b://c.org/", "http://x.com\n.org/fr/",
]


def test_hosts_and_rules(spark):
    rows = spark.createDataFrame(list(enumerate(URLS)), "page_id bigint, url string")
    got = {r.id: r for r in urls.judge(rows).collect()}
    for i, url in enumerate(URLS):
        head, mark, rest = (url or "").partition("://")
        end = min((k for k in map(rest.find, "/?#") if k >= 0), default=len(rest))
        host = brute.lower(rest[:end]) if mark else ""
        path = rest[end:].split("?")[0].split("#")[0] if mark else ""
        fitting = [
            (len(rule), rule, said) for said, rule in urls.RULES
            if (host == rule.split("/")[0] or host.endswith("." + rule.split("/")[0]))
            and path.startswith("/" + rule.partition("/")[2])
        ]
        rule, verdict = max(fitting)[1:] if fitting else (None, "allow")  # no examples here, so nothing else is blocked
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict), url
    assert urls.judge(rows.limit(0)).count() == 0


def test_url_models_tell_hosts_apart(spark):
    rng = np.random.default_rng(0)
    name = lambda parts: "".join(rng.choice(parts, 3))
    good = [f"http://{name(['ther', 'and', 'ing', 'tion', 'her'])}.net/en/{k}" for k in range(600)]
    bad = [f"http://{w}-{name(['x', 'zz', 'q', 'win', '4u'])}.net/en/{k}" for k in range(300) for w in ["casino"]]
    unseen = [f"http://casinos-{name(['x', 'zz', 'q', 'win'])}.net/en/{k}" for k in range(40)]  # no listed word
    rows = [(i, u) for i, u in enumerate(good + bad + unseen)]
    verdicts = {r.id: r.verdict for r in urls.judge(spark.createDataFrame(rows, "page_id bigint, url string")).collect()}
    blocked = lambda part: np.mean([verdicts[i] == "block" for i in part])
    assert blocked(range(600)) <= 0.02 and blocked(range(600, 900)) >= 0.98


def test_url_scores_equal_plain_markov_model():
    seen = {1: [b"ab.c/x", b"ab.d/"], 0: [b"zz.c/"]}
    cells = [np.zeros((2, urls.CELLS), np.float32) for _ in range(2)]
    plain = defaultdict(Counter)
    for label, texts in seen.items():
        chars, own, _ = urls._laid_out(texts)
        for context, follow in urls._cells(chars):
            np.add.at(cells[0][label], context[own >= 0], 1)
            np.add.at(cells[1][label], follow[own >= 0], 1)
        for t in texts:
            padded = b"\x02" * urls.ORDER + t + b"\x03"
            for i in range(urls.ORDER, len(padded)):
                for k in range(urls.ORDER + 1):
                    plain[label, padded[i - k : i]][padded[i]] += 1
    tried = [b"ab.c/", b"zz", b""]
    for got, text in zip(urls.UrlModel(*cells).score(tried), tried):
        padded, total = b"\x02" * urls.ORDER + text + b"\x03", 0.0
        for i in range(urls.ORDER, len(padded)):
            for label, sign in ((1, 1), (0, -1)):
                p = 1 / 256
                for k in range(urls.ORDER + 1):
                    counts = plain[label, padded[i - k : i]]
                    n = sum(counts.values())
                    if n >= urls.LEAST_EVIDENCE:
                        p = (counts[padded[i]] + urls.SMOOTHING * p) / (n + urls.SMOOTHING)
                total += sign * math.log(p)
        assert got == pytest.approx(total / (len(text) + 1), abs=1e-5)


# -- embeddings


def planted_vectors(n=600, dims=32):
    rng = np.random.default_rng(2)
    v = rng.standard_normal((n, dims))
    for k in range(0, 240, 8):  # families at cosines from just above the limit upwards
        for j in range(1, 8):
            noise = rng.standard_normal(dims)
            noise -= noise @ v[k] / (v[k] @ v[k]) * v[k]
            c = rng.uniform(0.9, 0.999)
            v[k + j] = v[k] * c + noise * np.linalg.norm(v[k]) / np.linalg.norm(noise) * math.sqrt(1 - c * c)
    v[300:340] = v[300] + 0.01 * rng.standard_normal((40, dims))
    v[340:350] = v[300]
    return v


def test_embedding_links_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 64)  # so that cells are split into blocks
    v = planted_vectors()
    rows = [(int(i), [float(x) for x in r]) for i, r in enumerate(v)]
    odd = [(1000, None), (1001, [0.0] * 32), (1002, [float("nan")] * 32), (1003, [1.0, None]), (1004, []), (1005, [1.0, 2.0]),
           (1006, [2.0, 4.0]), (1007, [float("inf")] + [0.0] * 31), (1001, [-0.0] * 32)]
    table = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>").withColumn("id", F.lit("clash"))
    found = embeddings.near_duplicates(table).collect()
    got = {r.id: r for r in found}
    assert len(found) == len(rows) + len(odd)
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    links = np.array([got[i].n_links for i in range(len(v))])
    assert (links <= near.sum(axis=1)).all() and links.sum() >= 0.97 * near.sum()
    roots = brute.components(range(len(v)), lambda a, b: bool(near[a, b]))
    assert np.mean([got[i].component_id == roots[i] for i in range(len(v))]) >= 0.98
    assert all(got[i].kept == (got[i].component_id == i) for i in range(len(v)))
    assert all((got[i].n_links, got[i].component_id) == (0, i) for i in (1000, 1001, 1002, 1003, 1004, 1007))
    assert (got[1005].n_links, got[1006].component_id) == (1, 1005)
    assert embeddings.near_duplicates(table.limit(0)).count() == 0


def test_embedding_query_equals_brute_force(spark, folder):
    got = {r.vec_id: r for r in queries.op6_embedding_near_dedup(spark, folder).collect()}
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{folder}/embeddings.parquet'").fetchall()
    v = np.array([r[1] for r in rows])
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    assert sum(got[r[0]].n_links for r in rows) >= 0.9 * near.sum() and len(got) == len(rows)


def test_plan_follows_from_rows():
    small, large = embeddings.plan_for(1000, 64), embeddings.plan_for(10**9, 64)
    assert small.depth < large.depth and small.tables < large.tables and small.least_count == large.least_count
    # What is missed at the limit: pairs that meet nowhere, or count too little.
    spread = math.sqrt(0.2)
    near = embeddings.same_cell_chance(embeddings.CELL_WIDTH, spread)
    assert 1 - (1 - near**large.depth) ** large.tables >= embeddings.MEET_RECALL


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(k, k + 1) for k in range(1000, 1100)]
    rows = spark.createDataFrame([*edges, (7, 7), (None, 3)], "a bigint, b bigint")
    got = {r.node: r.root for r in connected_components(rows).collect()}
    linked = {frozenset(e) for e in edges if e[0] != e[1]}
    roots = brute.components({n for e in linked for n in e}, lambda a, b: frozenset((a, b)) in linked)
    assert got == roots
    assert connected_components(rows.limit(0)).count() == 0


# -- sharding


def shard_laws(rows, shards, n):
    places = defaultdict(list)
    for r in rows:
        places[r.shard].append(r.slot)
    counts = [len(places[s]) for s in range(shards)]
    assert sum(counts) == n and max(counts) - min(counts) <= 1
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_sharding_query_keeps_the_law(spark, folder):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall())
    rows = queries.op8_sharding(spark, folder).collect()
    shard_laws(rows, 24, len(texts))
    groups = defaultdict(set)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "rows", None)
        groups[texts[r.doc_id]].add(r.shard)
    assert all(len(g) == 1 for g in groups.values())


def test_large_groups_are_shared_by_few_shards(spark):
    texts = ["same"] * 400 + ["pair"] * 30 + [None] * 20 + [f"single {i}" for i in range(550)]
    rows = sharding.shard(brute.odd_docs(spark, [(i, t, "en", "a", 0, None) for i, t in enumerate(texts)]), shards=10).collect()
    shard_laws(rows, 10, 1000)
    spread = defaultdict(set)
    for r in rows:
        spread[texts[r.id]].add(r.shard)
    assert len(spread["pair"]) == 1 and len(spread[None]) <= 2 and len(spread["same"]) <= 9


def test_sharding_takes_odd_rows(spark):
    rows = sharding.shard(brute.odd_docs(spark), shards=24).collect()
    shard_laws(rows, 24, len(brute.ROWS))
    assert sharding.shard(brute.odd_docs(spark, [])).count() == 0


# -- language model


def check_base(rows, found):
    tokens = [[*brute.words(brute.lower(r[1])), None] for r in rows]
    held = [r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in rows]
    counts = Counter(w for own, h in zip(tokens, held) if not h for w in own)
    n, v = sum(counts.values()), len(counts)
    expected = sorted(
        (str(r[0]), h, len(own), sum(counts[w] > 0 for w in own), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own))
        for r, own, h in zip(rows, tokens, held)
    )
    got = sorted((str(r.id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found)
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    assert [g[5] for g in got] == pytest.approx([e[5] for e in expected], rel=1e-9)


def test_lm_query_equals_brute_force_and_beats_the_base(spark, folder):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall()
    found = queries.op9_lm_scoring(spark, folder).withColumnRenamed("doc_id", "id").collect()
    check_base(rows, found)
    held = [r for r in found if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_takes_odd_rows(spark):
    check_base(brute.ROWS, lm.score(brute.odd_docs(spark)).collect())
    held = [(i, "some words here", "en", "a", 0, None) for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    check_base(held, lm.score(brute.odd_docs(spark, held)).collect())  # nothing to learn from
    assert lm.score(brute.odd_docs(spark, [])).count() == 0


def test_model_is_normalised(spark, monkeypatch):
    rows = [(i, f"alpha beta w{i % 9} gamma w{i % 4}", "en", "a", 0, None) for i in range(80)]
    docs = brute.odd_docs(spark, rows)
    counts = lm.word_counts(docs)
    words = lm.vocabulary(counts, share=0.02)  # some words are not frequent here
    model = lm.fit(docs, words)
    assert np.allclose(model.chances.sum(axis=2), 1, atol=1e-4)
    # Over all words seen, and one for all others, the chances after any context add up to one.
    vocabulary = [bytes(r.word) for r in counts.where("word IS NOT NULL").collect()] + [b"never seen"]
    seen = {bytes(r.word): r.n for r in counts.where("word IS NOT NULL").collect()}
    total = 0.0
    for before in ([b"alpha"],):
        for w in [*vocabulary, None]:
            text = [*before, w] if w else before
            found = words.find(text)
            classes = words.classes(found)
            own = classes[:2]  # the word (or the end) after the context
            p = sum(lw * c[lm._before(own, lag)[1], own[1]] for lw, lag, c in zip(lm.LAG_WEIGHTS, lm.LAGS, model.chances))
            total += p * ((seen.get(w, 0) + 1) / model.other_mass if w and own[1] == lm._OTHER else 1)
    assert total == pytest.approx(1, abs=1e-4)
    # Context tells: after alpha comes beta.
    at = {w: words.places[w] + 1 for w in (b"alpha", b"beta", b"gamma")}
    assert model.chances[0][at[b"alpha"], at[b"beta"]] > 0.9 > 0.5 > model.chances[0][at[b"alpha"], at[b"gamma"]]


# -- pipeline


def test_pipeline_stages(spark, folder):
    import corpus_pipeline

    from ontime.llm.common import stage

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, step in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(step(spark, docs, folder), "trial")
        assert docs.columns == columns
        seen[name] = before, docs
    before, good = seen["quality_rules"]
    texts = {r.doc_id: r.text for r in good.collect()}
    failed = {r.doc_id for r in before.collect() if brute.base_statistics(r.text)[-1]}
    assert not failed & set(texts) and len(texts) >= 0.8 * (before.count() - len(failed))
    prints = {d: brute.simhash(t) for d, t in texts.items()}
    roots = brute.components(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    assert {r.doc_id for r in seen["near_duplicates"][1].collect()} == set(roots.values())
    mixed = Counter(r.doc_id for r in seen["source_mix"][1].collect())
    assert set(mixed) <= set(roots.values()) and max(mixed.values()) <= 2
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    whole = Counter(r.doc_id for r in pieces if r.start == 0)
    assert whole == mixed
    assert Counter(map(tuple, pieces)) == Counter(map(tuple, corpus_pipeline.run(spark, folder).collect()))
