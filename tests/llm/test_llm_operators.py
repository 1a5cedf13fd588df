import collections
import glob
import hashlib
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import Row, functions as F

from regionlake.llm import backoff, base, fingerprints, line_dedup, passages, pieces, quotations, queries, templates, token_counts, toxicity
from regionlake.llm.components import components
from regionlake.llm.ngram_join import Alike, AcrossPairs, Tiles, _bitmap, differing, ngram_jaccard
from regionlake.session import shared_dir
from suite.check import compare, connect

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
EMPTY = []


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute_groups(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = words_of(t)
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}
    group = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if group[a] < group[b] and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    group[b], changed = group[a], True
    return {i: (len(sets[i]), group[i]) for i in sets}


@pytest.mark.parametrize("percent", [60, 85])
def test_ngram_join_equals_brute_force(docs, percent):
    random.seed(percent)
    rows = []
    for g in range(6):
        base = [random.choice("abcdefghijklmnop") * 3 + str(random.randint(0, 40)) for _ in range(random.randint(3, 80))]
        for _ in range(14):
            w = list(base)
            for _ in range(random.randint(0, 4)):
                w[random.randrange(len(w))] = random.choice("xyz") + str(random.randint(0, 9))
            rows.append((len(rows), " ".join(w)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard(docs(rows), percent=percent).collect()}
    assert got == brute_groups(rows, 4, percent)


def test_ngram_join_of_groups_whose_heads_are_common(docs):
    """Every shingle is in 16 texts or more, so the stored heads do not settle the prefix; two rows lack a key."""
    random.seed(5)
    rows = []
    for g, copies in ((0, 44), (1, 24)):
        base = [f"w{g}x{random.randint(0, 500)}" for _ in range(90)]
        for _ in range(copies):
            w = list(base)
            for _ in range(random.randint(0, 3)):
                w[random.randrange(len(w))] = f"z{random.randint(0, 3)}"
            rows.append((len(rows), " ".join(w)))
        rows += [(len(rows), " ".join(base[:45] + [f"own{g}{i}" for i in range(45)]))]
    lone = [f"n{i}" for i in range(60)]
    without = [(None, " ".join(lone)), (None, " ".join([*lone, "end"]))]
    got = ngram_jaccard(docs(rows + without)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == brute_groups(rows, 4, 85)
    assert sorted((r.n_shingles, r.component_id) for r in got if r.doc_id is None) == [(57, None), (58, None)]


def test_tiles_with_the_same_members_are_one():
    """Forty tokens shared by two sets, five of them by a third as well, dealt over four tasks."""
    members = [(t, n, s) for t in range(40) for n, s in ((100, 7), (105, 9), (110, 8))[: 3 if t < 5 else 2]] + [(50, 90, 3)]
    batch = lambda rows: base.table({c: np.array(x, np.int64) for c, x in zip(("token", "n", "set_id"), zip(*rows))})
    alike = [r for task in range(4) for b in Alike(80)([batch([m for m in members if m[0] % 4 == task])]) for r in b.to_pylist()]
    alike.sort(key=lambda r: (r["token"], r["n"], r["set_id"]))
    held = base.table({c: np.array([r[c] for r in alike], np.int64) for c in ("token", "n", "set_id", "seen")})
    tiles = [r for b in Tiles(80)([held]) for r in b.to_pylist()]
    assert sorted((r["set_id"], r["members"], r["copies"]) for r in tiles) == [(7, 2, 35), (7, 3, 5), (8, 3, 5), (9, 2, 35), (9, 3, 5)]
    placed = base.table({**{c: np.array([r[c] for r in tiles], np.int64) for c in ("token", "n", "set_id", "copies")},
                         "component": np.array([r["set_id"] for r in tiles], np.int64), "bitmap": base.binary([None] * len(tiles))})
    pairs = [r for b in AcrossPairs(80)([placed]) for r in b.to_pylist()]
    assert {(r["a"], r["b"]): r["tiles"] for r in pairs} == {(7, 9): 40, (7, 8): 5, (8, 9): 5}


def test_bitmaps_bound_a_difference_in_four_bits_an_element():
    draw = np.random.default_rng(3)
    for n in (1, 40, 700, 3000):
        sets = draw.integers(0, 2**63, 2 * n, dtype=np.uint64)
        for both in (0, n // 2, n):
            x, y = sets[:n], sets[n - both : 2 * n - both]
            assert len(_bitmap(x)) * 8 <= max(64, 4 * n)
            assert differing(_bitmap(x), _bitmap(y)) <= 2 * (n - both)
            assert differing(_bitmap(x), _bitmap(np.concatenate((x, y[both:])))) <= n - both


def test_ngram_join_removes_the_tables_nothing_reads_again(docs, spark):
    large = ("signatures", "bitmaps", "tiles", "large-arrays", "across-arrays")
    there = lambda: {f for x in large for f in glob.glob(f"{shared_dir(spark).removeprefix('file://')}/regionlake/{x}-*")}
    before = there()
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*words, *[f"x{i}y{j}" for j in range(3)]])) for i in range(12)]
    assert {r.component_id for r in ngram_jaccard(docs(rows)).collect()} == {0}
    assert there() == before


def test_ngram_join_edges(edges, docs):
    rows = ngram_jaccard(edges).collect()
    got = {r.doc_id: r.component_id for r in rows}
    assert len(rows) == 12
    assert got[5] == got[6] == got[7] == got[9] == 5 and got[10] == 10 and got[None] is None
    assert [got[i] for i in (1, 2, 3, 4)] == [1, 2, 3, 4]
    assert ngram_jaccard(docs(EMPTY)).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (7, 7), (None, 3)]
    got = dict(components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert got == {**{i: 1 for i in range(2, 41)}, 101: 100}


def test_fingerprints(edges, docs):
    lexicon = np.concatenate([fingerprints.terms(BASE_TERMS), fingerprints.terms("other1 other2")]).view(np.int64)
    rows = fingerprints.edit_stability(edges, lexicon).collect()
    assert len(rows) == 12
    prints = collections.defaultdict(set)
    texts = sorted(((r.key_, r.text_) for r in edges.select(F.col("doc_id").alias("key_"), F.coalesce("text", F.lit("")).alias("text_")).collect()),
                   key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for i, (k, t) in enumerate(texts):
        after, n = texts[(i + 1) % len(texts)][1], len(t)
        want.append((k, n, hashlib.sha256((t[: n - n // 4] + after[: n // 4]).encode()).hexdigest()))
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.n_chars, r.edited_sha256)) for r in rows)
    for r in rows:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        prints[r.doc_id].add(r.fingerprint)
    assert prints[5] == prints[6] and len(prints[6]) == 1 and prints[1] == prints[2] == prints[3] and prints[5] != prints[10]
    assert fingerprints.edit_stability(docs(EMPTY), lexicon).count() == 0


BASE_TERMS = " ".join(f"word{i}" for i in range(60))


def test_successors(spark):
    keys = spark.createDataFrame([(k,) for k in (5, 1, 9, 7, 7, -3, None)], "k long")
    assert dict(fingerprints.successors(keys, "k").collect()) == {-3: 1, 1: 5, 5: 7, 7: 9, 9: -3}


def test_token_counts(docs, edges):
    vocabulary = token_counts.ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    counter = token_counts.Counter(public_tokenizers.PATTERN, vocabulary)
    random.seed(1)
    alphabet = "ab c'\n  re's 12,.!éß  \t''ll"
    for _ in range(400):
        text = "".join(random.choice(alphabet) for _ in range(random.choice([0, 3, 40, 400])))
        tree = token_counts.Tree(*token_counts.leaves(counter, text))
        for _ in range(4):
            a = random.randint(0, len(text) + 2)
            new, b = "".join(random.choice(alphabet) for _ in range(random.randint(0, 9))), a + random.randint(0, 8)
            want = text[:a] + new + text[b:]
            text, _ = token_counts.edit(counter, tree, text, a, b, new, 4)
            assert text == want and tree.tokens == len(counter.encoding.encode_ordinary(text)) and tree.chars == len(text)
    trees = token_counts.token_trees(edges, public_tokenizers.PATTERN, vocabulary)
    for edits in (queries.edits_of(trees), trees.withColumn("edits", F.lit(None).cast(token_counts.EDITS))):
        done = token_counts.apply_edits(edits, "edits", public_tokenizers.PATTERN, vocabulary).collect()
        assert len(done) == 12
        assert all(r.n_tokens == len(counter.encoding.encode_ordinary(r.text)) == sum(r.tokens) for r in done)
    assert token_counts.token_trees(docs(EMPTY), public_tokenizers.PATTERN, vocabulary).count() == 0


def test_passages(docs, edges):
    passage = ("The first planted sentence has eight or more words here. Another planted sentence follows it with more words. "
               "A third one ends the planted passage of some length.")
    rows = [(1, "Some host text that nobody shares at all begins " + passage + " and goes on with other things to say."),
            (2, "Quite another start " + passage), (3, "Nothing of this text is found in any other text of this table."), (4, None)]
    found = passages.repeated_passages(docs(rows)).collect()
    text = dict(rows)
    assert {r.doc_id for r in found} == {1, 2} and {r.doc_id for r in found if r.removed} == {2}
    assert any("Another planted sentence follows it with more words." == text[r.doc_id][r.start : r.stop] for r in found)
    assert all(r.first_doc_id == 1 and r.occurrences == 2 for r in found)
    got = passages.repeated_passages(edges).where("not removed").select("doc_id").distinct().collect()
    assert Row(doc_id=5) in got and Row(doc_id=10) not in got
    assert passages.repeated_passages(docs(EMPTY)).count() == 0
    assert passages.bands(0.8, 0.995) == 4 and 1 - (1 - 0.8) ** 4 >= 0.995


@pytest.mark.parametrize("every", [0, 4])
def test_passages_without_or_with_short_sentences(docs, every):
    random.seed(9)
    draw = lambda n: [f"w{random.randrange(5000)}x" for _ in range(n)]
    rows = []
    for i in range(40):
        passage = draw(50)
        if every:
            passage = [w + "." * (j % every == every - 1) for j, w in enumerate(passage)]
        for side in range(2):
            host = [w + "." * (random.random() < 0.3 and every > 0) for w in draw(60)]
            at = random.randrange(60)
            rows.append((2 * i + side, " ".join(host[:at] + passage + host[at:])))
    found = passages.repeated_passages(docs(rows)).collect()
    assert {r.doc_id for r in found if r.removed} == set(range(1, 80, 2)) and {r.first_doc_id for r in found} == set(range(0, 80, 2))


def test_passages_of_long_sentences_with_a_changed_word(docs):
    sentence = [f"long{i}" for i in range(70)]
    changed = sentence[:35] + ["other"] + sentence[36:]
    rows = [(1, " ".join(sentence) + "."), (2, " ".join(changed) + ".")]
    found = passages.repeated_passages(docs(rows)).collect()
    assert any(r.doc_id == 2 and r.removed and r.n_words == 70 for r in found)


def test_backoff_equals_brute_force(spark, edges, tmp_path):
    edges.write.parquet(str(tmp_path / "docs"))
    stored = spark.read.parquet(str(tmp_path / "docs"))
    texts = [(r.doc_id, words_of(r.text)) for r in stored.collect()]
    for order in (2, 3):
        count, total = collections.Counter(), sum(len(w) for _, w in texts)
        for _, w in texts:
            for n in range(1, order + 1):
                count.update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))

        def score(w, i, n):
            if n == 1:
                return math.log(count[(w[i],)] / total)
            if i < n - 1:
                return score(w, i, n - 1)
            g = tuple(w[i - n + 1 : i + 1])
            return math.log(count[g] / count[g[:-1]]) if count[g] >= 2 else math.log(0.4) + score(w, i, n - 1)

        want = sorted((str(k), len(w), round(sum(score(w, i, order) for i in range(len(w))), 6)) for k, w in texts)
        rows = backoff.stupid_backoff(stored, order=order).collect()
        assert sorted((str(r.doc_id), r.n_words, round(r.log_score, 6)) for r in rows) == want
    hashes = np.unique(np.random.default_rng(1).integers(0, 2**63, 1000, dtype=np.uint64))
    assert (backoff.unpacked(backoff.packed(hashes)) == hashes).all() and len(backoff.unpacked(b"")) == 0


def test_backoff_keeps_only_counts_between_rounds(spark, edges, tmp_path, monkeypatch):
    """Words with pairs, and triples, are asked for apart; a round's requests go with its write, the result shuffles no request."""
    cleanup, seen = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", []

    def stored(df, label):
        seen.append((label, df.columns, spark.conf.get(cleanup)))
        return base.stored(df, label)

    monkeypatch.setattr(backoff, "stored", stored)
    edges.write.parquet(str(tmp_path / "docs"))
    before = spark.conf.get(cleanup)
    plan = backoff.stupid_backoff(spark.read.parquet(str(tmp_path / "docs")), order=3)._jdf.queryExecution().executedPlan().toString()
    assert seen == [(f"answers-{i}", ["block", "turn", "bucket", "counts"], "true") for i in (0, 1)]
    assert spark.conf.get(cleanup) == before
    assert plan.count("Exchange ") == 1 and "hashes" not in plan


def test_backoff_query_scores_trigrams(spark):
    sf = "/root/testdata/sf0.001"
    scores = lambda df: {r.doc_id: round(r.log_score, 6) for r in df.collect()}
    of_order = lambda n: scores(backoff.stupid_backoff(queries.read(spark, sf, "documents"), order=n))
    assert scores(queries.QUERIES["op5_stupid_backoff"](spark, sf)) == of_order(3) != of_order(2)


def test_toxicity(spark, docs, edges):
    random.seed(2)
    word = lambda: random.choice(["ba", "ko", "li"]) + random.choice(["mer", "tun", "sol", "dak"])
    rows, marks = [], []
    for i in range(400):
        parts = [" ".join(word() for _ in range(8)) for _ in range(5)]
        bad = i % 4 == 0
        if bad:
            parts[2] += " vilest grumbler"
        rows.append((i, ". ".join(parts) + "."))
        marks.append((i, int(bad)))
    marks += [(None, 1), (3, None), (9999, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    model = toxicity.train(docs(rows), labels.where("doc_id is null or doc_id < 300"))
    scored = toxicity.score(docs(rows), model)
    got = {r.doc_id: (r.score >= 0.7, r.offending) for r in scored.where("doc_id >= 300").collect()}
    assert all(got[i][0] == (i % 4 == 0) for i in got)
    assert all("grumbler" in rows[i][1][s.start : s.end] for i in got for s in got[i][1])
    assert toxicity.score(edges, model).where("score between 0 and 1").count() == 12
    kept = toxicity.without_toxic(edges, model)
    assert kept.columns == edges.columns and kept.count() == 12
    assert toxicity.train(docs(EMPTY), labels.limit(0)).grams == []


def test_a_long_clean_text_keeps_its_score(spark, docs):
    random.seed(2)
    sentence = lambda: " ".join(random.choice(["ba", "ko", "li"]) + random.choice(["mer", "tun", "sol", "dak"]) for _ in range(8)) + ". "
    rows = [(i, "".join(sentence() + "vilest grumbler. " * (i % 4 == 0) for _ in range(5))) for i in range(200)]
    model = toxicity.train(docs(rows), spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int"))
    clean = "".join(sentence() for _ in range(30_000))
    assert model.score(clean)[0] < 0.5 and abs(model.score(clean)[0] - model.score(sentence())[0]) < 1e-9
    assert model.score(clean + "vilest grumbler.")[0] > 0.7


def test_pieces(docs, edges):
    assert pieces.agreement(edges, MODEL).where("not agrees").count() == 0
    texts = ["", " ", "  a  ▁b ", "\n\n", "a\x00b", "<s> </s> <0x0A>", "𝒳🇫🇷 é", "x" * 3000, "a   b\n c"]
    assert pieces.agreement(docs(list(enumerate(texts))), MODEL).where("not agrees").count() == 0
    both = pieces.decode(pieces.encode(edges, MODEL), MODEL)
    assert both.exceptAll(pieces.round_trip(edges, MODEL)).count() == 0 and both.count() == 12
    v = pieces.Vocabulary(pieces.model_bytes(MODEL))
    random.seed(4)
    for _ in range(500):
        ids = [random.choice([random.randint(0, 31999), random.randint(3, 258)]) for _ in range(random.randint(0, 9))]
        assert v.decode(ids) == v.library.decode(ids)
    assert pieces.encode(docs(EMPTY), MODEL).count() == 0


def test_templates(spark, docs, edges):
    items = spark.createDataFrame([
        (1, "Alice eats 12 of them before the long day ends while Alice sells 12 of the rest"), (2, None), (3, ""), (4, "two words"),
    ], "item_id long, text string")
    rows = [(1, "it says: Robert eats 7 of them before the long day ends while Robert sells 7 of the rest, they said"),
            (2, "Robert eats 7 of them before the long day ends while Maria sells 9 of the rest"), (3, None), (4, "two words"),
            (5, "Alice eats 12 of them before the long day ends while Alice sells 12 of the rest"), (6, "nothing like it")]
    got = {(r.doc_id, r.item_id): r for r in templates.leaks(docs(rows), items).collect()}
    assert set(got) == {(1, 1), (4, 4), (5, 1)}
    assert got[1, 1].reparameterised and got[1, 1].changed_slots == 2 and not got[5, 1].reparameterised
    assert templates.leaks(edges, items).count() == 0 and templates.leaks(docs(EMPTY), items).count() == 0
    assert templates.leaks(edges, items.limit(0)).count() == 0


def test_line_dedup(docs, edges):
    run = "alpha line\nbeta line\ngamma line"
    rows = [(1, "x\n" + run + "\ny"), (2, "p\n\n" + run + "\nq"), (3, "alpha line\nbeta line"), (4, run), (5, None), (6, ""), (7, "a\na\na\na\na")]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs(rows)).collect()}
    assert got == {1: rows[0][1], 2: "p\n\nq", 3: rows[2][1], 4: "", 5: None, 6: "", 7: "a"}
    assert line_dedup.dedup_lines(edges).count() == 12 and line_dedup.dedup_lines(docs(EMPTY)).count() == 0


def test_quotations(spark):
    rows = [(1, 1, "Hello there\nsecond line"), (1, 2, "An answer\nBob wrote:\n> Hello there\n> second line"),
            (1, 3, "More\n> An answer\n>> Hello there\n>> second line"), (1, 4, "> second line\npart"), (2, 1, "> Hello there\nelsewhere"),
            (None, 1, "x"), (1, None, "> Hello there"), (1, 5, None)]
    got = quotations.linked(spark.createDataFrame(rows, "conv_id long, turn long, text string"), text="text").collect()
    by = {(r.conv_id, r.turn): (r.text, r.parent, r.root, r.depth) for r in got}
    assert by[1, 2] == ("An answer", 1, 1, 1) and by[1, 3] == ("More", 2, 1, 2) and by[1, 4] == ("part", 1, 1, 1)
    assert by[2, 1] == ("elsewhere", None, 1, 0) and by[1, 5] == ("", None, 5, 0) and by[1, None][1] is None and len(got) == 8
    assert quotations.linked(spark.createDataFrame([], "conv_id long, turn long, text string")).count() == 0


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_queries_equal_their_sql(spark, name):
    status, _, _, note = compare(spark, connect(SF), SF, name, queries.QUERIES[name], queries.ORACLES[name])
    assert status == "ok", note


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.ORACLES])
def test_other_queries_run(spark, name):
    assert queries.QUERIES[name](spark, SF).count() > 0


def test_leaks_are_the_planted_ones(spark):
    docs, items = (queries.read(spark, SF, t) for t in ("documents", "benchmark"))
    found = {r.doc_id for r in templates.leaks(docs, items).collect()}
    item = [r.text for r in items.collect()]
    assert found == {r.doc_id for r in docs.collect() if any(t in r.text for t in item)}


@pytest.mark.parametrize("name", ["op8_template_decontamination", "op9_line_dedup"])
def test_native_queries_run_no_python(spark, name):
    df = queries.QUERIES[name](spark, SF)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in ("MapInArrow", "MapInPandas", "Python", "ArrowEval", "FlatMapGroups") if w in text]


def test_toxicity_does_not_depend_on_the_layout(spark):
    """The same rows over one, three and eight partitions give the same model and the same scores."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    found = []
    for n in (1, 3, 8):
        rows = docs.repartition(n)
        model = toxicity.train(rows, labels, per_class=60)
        found.append((model.grams, {r.doc_id: r.score for r in toxicity.score(rows, model).collect()}))
    assert found[0] == found[1] == found[2] and len(found[0][0]) > 3


def test_toxicity_keeps_columns_of_many_rows(spark, docs):
    """More rows than are scored at a time, all columns kept in their order."""
    model = toxicity.Model([" vile "], np.array([9.0]), -4.0, -8.0)
    rows = [(i, "a vile thing" if i % 5 == 0 else "a fine thing") for i in range(3 * toxicity.ROWS)]
    kept = toxicity.without_toxic(docs(rows).withColumn("score", F.lit("clash")), model)
    assert kept.columns == [*docs([]).columns, "score"]
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, _ in rows if i % 5]


def test_fingerprints_plan_no_nested_loop(spark):
    df = queries.QUERIES["op2_imatch_fingerprints"](spark, SF)
    df.collect()
    assert "NestedLoop" not in df._jdf.queryExecution().executedPlan().toString()
