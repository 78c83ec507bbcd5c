"""Cases in which an operator would do less than the whole job."""

import collections

import numpy as np
import pandas as pd
import pytest


def test_small_groups_beside_a_large_one(spark, monkeypatch):
    """One group of 200 outweighs 60 pairs in a ratio over all links."""
    from tesselith.llm import nn_descent

    for name, value in (("ORDERS", 1), ("ROUNDS", 0), ("ATTEMPTS", 1)):
        monkeypatch.setattr(nn_descent, name, value)
    g = np.random.default_rng(8)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    one, pairs = unit(g.standard_normal(32)), unit(g.standard_normal((60, 32)))
    v = np.concatenate((one + 0.01 * g.standard_normal((200, 32)), pairs, pairs + 0.05 * g.standard_normal((60, 32)))).astype(np.float32)
    rows = [(100 * i, v[i].tolist(), 0) for i in range(len(v))]
    x = unit(v.astype(float))
    near = x @ x.T >= 0.93
    np.fill_diagonal(near, False)
    out, _ = nn_descent.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    got = {r.vec_id: (r.n_links, r.component_id) for r in out.collect()}
    for i in range(len(v)):
        assert got[100 * i] == (near[i].sum(), 100 * min(np.flatnonzero(near[i]).tolist() + [i]))


def test_a_clause_is_read_from_its_start():
    from tesselith.llm.toxicity import PRIOR, Grammar

    g, filler = Grammar({"idiot": 4.0}), "word " * 60
    assert g.score("you " + filler + "kill") == g.score("you kill") > PRIOR + 0.1
    assert g.score("you. " + filler + "kill") == pytest.approx(PRIOR)
    assert g.score("said " + filler + "idiot") == g.score("said idiot") < g.score("idiot")


def test_null_ids_keep_their_own_texts_without_repeated_words(spark):
    from tesselith.llm.phrase_automata import remove_repeated

    passage = " ".join(f"p{i}" for i in range(20))
    texts = [passage, passage + " and four more words", " ".join(f"q{i}" for i in range(24)), " ".join(f"r{i}" for i in range(24))]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in zip((1, None, None, None), texts)], "doc_id long, text string, n_chars long")
    assert sorted((r.text, r.n_chars) for r in remove_repeated(docs).collect()) == sorted((t, len(t)) for t in (texts[0], "and four more words", texts[2], texts[3]))


def test_null_ids_are_mixed(spark):
    from tesselith.llm.mixing import mix, mix_plan

    rows = [(None if i % 3 else i, " ".join(f"w{i}" for _ in range(i % 7 + 1)), f"s{i % 4}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mix_plan(docs).toPandas()
    mixed = collections.Counter()
    for r in mix(docs).collect():
        mixed[r.source] += len(r.text.split())
    for source, x in plan.groupby("source"):
        assert abs((x.copies * x["size"]).sum() - x.target.iloc[0]) <= 7 and abs(mixed[source] - x.target.iloc[0]) <= 7


def test_near_copies_with_null_ids_only_are_linked(spark):
    from tesselith.llm.minhash_forest import near_duplicates

    w = [f"w{i}" for i in range(80)]
    docs = spark.createDataFrame([(None, " ".join(w[:-1])), (5, " ".join(w)), (7, "other words here now and then some")], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in near_duplicates(docs, k=4).collect()} == {(None, 5), (5, 5), (7, 7)}


def test_a_rare_offence_is_learned(spark):
    """Eight of 1,000 toxic texts, and no clean one, hold it."""
    from tesselith.llm.toxicity import learn_stems

    rows = [("common word", 1)] * 992 + [("common dolt", 1)] * 8 + [("common word", 0)] * 5000
    assert any("dolt".startswith(s) for s in learn_stems(spark.createDataFrame(rows, "text string, toxic int")))


def test_an_anchor_with_very_many_fragments(spark, monkeypatch):
    """Texts that share a passage in the middle only: its edges differ in all of them, and go window by window."""
    import random

    from tesselith.llm import phrase_automata, recurrence, suffix_arrays

    monkeypatch.setattr(recurrence, "CROWDED", 200)
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passage = " ".join(word() for _ in range(40))
    texts = [" ".join(word() for _ in range(rng.randint(1, 30))) + " " + passage + " " + " ".join(word() for _ in range(9)) for _ in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for removals, split, window in ((phrase_automata.removals, str.split, 13), (suffix_arrays.removals, list, 50)):
        seen, want = {}, {}
        for i, t in enumerate(texts):
            x, gone = split(t), set()
            for s in range(len(x) - window + 1):
                if seen.setdefault(tuple(x[s : s + window]), i) < i:
                    gone |= set(range(s, s + window))
            want[i] = len(gone)
        assert sum(want.values()) > 2000
        assert {r.doc_id: r.n_removed for r in removals(docs).collect()} == want


def test_shared_and_null_ids_of_different_texts(spark):
    """Rows (1, A), (2, B), (2, C), (null, D), (null, E): B and D lose words to A, and C and E keep theirs."""
    from tesselith.llm import suffix_arrays
    from tesselith.llm.phrase_automata import remove_repeated

    a, c, e = (" ".join(f"{x}{i}" for i in range(24)) for x in "ace")
    b, d = (a + " " + " ".join(f"{x}{i}" for i in range(4)) for x in "bd")
    rows = [(1, a, "x"), (2, b, "x"), (2, c, "x"), (None, d, "x"), (None, e, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _kept string")
    got = {(r.doc_id, r.text, r._kept) for r in remove_repeated(docs).collect()}
    assert got == {(1, a, "x"), (2, "b0 b1 b2 b3", "x"), (2, c, "x"), (None, "d0 d1 d2 d3", "x"), (None, e, "x")}
    got = [(r.doc_id, r.n_bytes, r.n_removed) for r in suffix_arrays.removals(docs).collect()]
    assert sorted(got, key=str) == sorted([(1, len(a), 0), (2, len(b), len(a)), (2, len(c), 0), (None, len(d), len(a) + 1), (None, len(e), 0)], key=str)


def test_one_of_each_group_stays_whatever_the_ids(spark):
    """Rows (1, X), (5, near X), (5, another), (null, near X), (null, Y), (null, near Y)."""
    from tesselith.llm.minhash_forest import keep_one, near_duplicates

    x, y, z = ([f"{c}{i}" for i in range(80)] for c in "xyz")
    rows = [(1, x), (5, x[:-1]), (5, z), (None, x[1:]), (None, y), (None, y[:-1]), (7, [])]
    docs = spark.createDataFrame([(i, " ".join(t), "c") for i, t in rows], "doc_id long, text string, _doc string")
    left = [(r.doc_id, r.text.split()) for r in keep_one(docs).collect()]
    assert len(left) == 4 and (1, x) in left and (5, z) in left and (7, []) in left
    assert sum(t in (y, y[:-1]) for _, t in left) == 1
    assert sum(not r.kept for r in near_duplicates(docs).collect()) == 2  # of the class of 1; texts under null ids are one document


def test_rows_of_one_id_are_mixed_each_for_itself(spark):
    from tesselith.llm.mixing import mix, mix_plan

    rows = [(i // 3, " ".join(f"w{i}" for _ in range(i % 5 + 1)), f"s{i % 4}", "c") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _copies string")
    plan = mix_plan(docs).toPandas()
    mixed = collections.Counter()
    for r in mix(docs).collect():
        mixed[r.source] += len(r.text.split())
    for source, x in plan.groupby("source"):
        assert mixed[source] == (x.copies * x["size"]).sum() and abs(mixed[source] - x.target.iloc[0]) <= 5


def test_doubles_are_compared_as_doubles(spark):
    """Two vectors whose cosine falls below the threshold only beyond single precision."""
    from tesselith.llm.nn_descent import near_vectors

    t = np.arccos(0.93)
    rows = [(i, [float(np.cos(a)), float(np.sin(a))], 0) for i, a in ((1, 0.0), (2, t + 1e-10), (3, -t + 1e-10))]
    out = {r.vec_id: r.n_links for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))[0].collect()}
    assert out == {1: 1, 2: 0, 3: 1}


def test_the_pipeline_on_empty_tables_and_clashing_names(spark, tmp_path):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, node long, copies long, key string"
    for where, rows in (("none", []), ("some", [(i, f"a few words for number {i} " * (i % 4), "en", f"s{i % 3}", 9, "r", i, i, "k") for i in range(30)] + [(None, None, None, None, None, None, None, None, None)] * 2)):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{where}/documents.parquet")
        spark.createDataFrame([(i, 1, int(i == 3)) for i in range(len(rows))], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{where}/labels.parquet")
        out = corpus_pipeline.run(spark, f"{tmp_path}/{where}").collect()
        assert bool(out) == bool(rows)


def test_the_audit_of_near_copies(spark):
    """All links of query documents lie in one class, and are as many as brute force finds."""
    import random

    from tesselith.llm.minhash_forest import audit

    rng, texts = random.Random(2), []
    for _ in range(40):
        w = [f"v{rng.randrange(5000)}" for _ in range(60)]
        texts += [" ".join(w), " ".join([*w[:-2], "x", "y"]), " ".join(w[:30])]
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    want = sum(1 for a in range(0, 120, 4) for b in range(120) if a != b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    docs = spark.createDataFrame([(25 * i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert want > 10 and audit(docs) == (want, want)
