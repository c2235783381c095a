import corpus_pipeline
from searchlens.llm import quality
from searchlens.llm.packing import pack_documents

from .edge import SF, documents, edge_docs
from .test_decontaminate import slow_leaks
from .test_simhash import slow_components, slow_print


def test_stages_against_brute_force(spark):
    """Every stage on what the one before it kept, and run() on the whole."""
    docs, expected = documents(spark), None
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        got = sorted(r["doc_id"] for r in out.collect())
        if name == "quality_classifier":
            model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            expected = sorted(i for (i, _), s in zip(before, model.score([t for _, t in before]), strict=True) if s >= 0.3)
        elif name == "exact_dedup":
            best = {}
            for i, t in before:
                best[t] = max(i, best.get(t, i))
            expected = sorted(best.values())
        elif name == "simhash_near_dedup":
            root = slow_components([slow_print(t) for _, t in before])
            least = {}
            for (i, _), r in zip(before, root, strict=True):
                least[r] = min(i, least.get(r, i))
            expected = sorted(least.values())
        else:
            shared = {}
            for i, t in items:
                for w in set(t.lower().split()):
                    if len(w) > 8:
                        shared.setdefault(w, set()).add(i)
            expected = []
            for d, t in before:
                near = set().union(*(shared.get(w, set()) for w in set(t.lower().split())))
                if not slow_leaks(t, [x for x in items if x[0] in near]):
                    expected.append(d)
            expected.sort()
        assert got == expected, name
        docs = spark.createDataFrame(out.collect(), out.schema)
    want = sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in pack_documents(docs).collect())
    whole = corpus_pipeline.run(spark, SF)
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in whole.collect()) == want
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_take_awkward_and_empty_tables(spark):
    for docs in (edge_docs(spark), edge_docs(spark, [])):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            n = out.count()
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns and n <= docs.count()
