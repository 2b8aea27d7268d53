from __future__ import annotations

import random
from collections import defaultdict
from fractions import Fraction

from helpers import documents, prose
from test_mixing import filled
from test_neardup import components, edited

import corpus_pipeline
from lakeloom.llm import decontaminate, neardup, toxicity


def test_stages_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        held = spark.createDataFrame(stage(spark, held, sf_dir).collect(), docs.schema)
        assert held.columns == docs.columns, name
    ids = {r["doc_id"] for r in held.collect()}
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in out} == ids and len(out) == len(ids)
    scores = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity_scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()}
    clean = docs.where(docs.doc_id.isin([i for i, p in scores.items() if not p]))
    kept = {r["doc_id"] for r in neardup.near_duplicates(clean).where("kept").collect()}
    found = {r["doc_id"] for r in decontaminate.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    assert ids == kept - found
    assert sum(r["taken"] for r in out) > 0


def test_without_rows(spark, sf_dir):
    empty = documents(spark, [(1, "x")]).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0, name


def test_all_stages_against_plain_ones(spark, tmp_path):
    """Texts with planted copies, passages, secrets and abuse; what is left, and how long it is, by plain code."""
    rnd = random.Random(11)
    text = lambda n: prose(rnd, n, 10**6)
    items = [" ".join(text(30)) for _ in range(4)]
    rows, toxic, secrets = [], {}, {}
    for i in range(0, 400, 2):
        words = text(rnd.randint(20, 120))
        kind = rnd.randrange(8)
        if kind == 0:
            words[5:5] = rnd.choice(items).split()[4:26]
        elif kind == 1:
            secrets[i] = "".join(rnd.choice("0123456789abcdef") for _ in range(40))
            words[3:3] = ["token", "=", f'"{secrets[i]}"']
        toxic[i] = int(kind in (2, 3))
        if toxic[i]:
            for _ in range(4):
                words.insert(rnd.randrange(len(words)), rnd.choice(["vileword", "nastyterm"]))
        rows.append((i, " ".join(words), rnd.choice(["a", "b", None])))
        if kind in (4, 5):
            rows.append((i + 1, " ".join(words if kind == 4 else edited(rnd, words, 1)), "b"))
            toxic[i + 1] = 0
    rows += [(1000, None, "a"), (1001, "", "b"), (None, "no id at all", "a")]
    docs = documents(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, t) for i, t in toxic.items()], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    kept = [r for r in rows if not toxic.get(r[0])]
    root = components([(i, t) for i, t, _ in kept if i is not None])
    kept = [r for r in kept if r[0] is None or root[r[0]][1] == r[0]]
    letters = lambda t: "".join(c for c in (t or "").lower() if c.isalnum())
    parts = {letters(x)[k : k + 59] for x in items for k in range(len(letters(x)) - 58)}
    kept = [r for r in kept if not any(p in letters(r[1]) for p in parts)]
    sizes = {i: len((t or "").replace(secrets.get(i, "\x00"), "[SECRET]").split()) for i, t, _ in kept}

    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"]: r["size"] for r in out} == sizes and len(out) == len(kept)
    names = ["a", "b", None]
    total = [sum(sizes[i] for i, _, s in kept if s == name) for name in names]
    goal = filled(total, [5, 2, 1], Fraction(3 * sum(total), 2))
    taken, source = defaultdict(int), {r[0]: r[2] for r in kept}
    for r in out:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
    assert all(abs(taken[n] - g) <= 64 for n, g in zip(names, goal, strict=True))
    masked = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in kept], docs.schema)
    found = {r["doc_id"]: r["text"] for r in dict(corpus_pipeline.STAGES)["secrets"](spark, masked, str(tmp_path)).collect()}
    assert all(value not in (found.get(i) or "") for i, value in secrets.items())
    assert all(found[i] == t for i, t, _ in kept if i not in secrets)
