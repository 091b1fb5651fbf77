import re
import struct

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from vacantia.llm import bpe, minhash, mixing, pii, quality, registry

from .test_minhash import Union, brute, shingle_set

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """What each stage was given and what it returned."""
    folder, docs, found = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(str(folder / name))
        out = spark.read.parquet(str(folder / name))
        found[name] = (docs, out)
        docs = out
    return {name: (docs.collect(), out.collect(), docs.columns, out.columns) for name, (docs, out) in found.items()}


def test_all_but_the_last_return_the_columns_of_documents(kept):
    for name, (_, rows, before, after) in kept.items():
        assert rows
        assert after == before or name == "tokens"


def test_quality_keeps_what_resampling_keeps(spark, kept):
    docs, out, *_ = kept["quality"]
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.fit(frame, spark.read.parquet(f"{SF}/labels.parquet"))
    weights = {r.doc_id: model.weight(r.text) for r in docs}
    n = sum(w is not None and w >= model.cut for w in weights.values())
    assert len(out) == n and set(out) <= set(docs)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    ids = {r.doc_id for r in out}
    share = lambda q: sum(d in ids for d in labels if labels[d] == q) / sum(v == q for v in labels.values())
    # so few labels leave the cut loose: it keeps good documents rather than all bad ones out
    assert share(1) > 0.98 and share(0) < 0.2


def test_one_of_each_near_duplicate_group_stays(kept):
    docs, out, *_ = kept["near_duplicates"]
    want = linked_at_80([(r.doc_id, r.text) for r in docs])
    assert sorted(r.doc_id for r in out) == sorted(d for d, root in want.items() if d == root)
    assert set(out) <= set(docs) and len(out) < len(docs)


def test_personal_data_is_gone_and_the_rest_is_untouched(kept):
    docs, out, *_ = kept["personal_data"]
    after = {r.doc_id: r for r in out}
    assert len(out) == len(docs)
    for row in docs:
        assert after[row.doc_id].text == pii.masked(row.text, pii.find_spans(row.text))
        assert after[row.doc_id].n_chars == len(after[row.doc_id].text)
        assert not [s for s in pii.find_spans(after[row.doc_id].text) if s[0] in pii.BASE]


def test_mixing_repeats_and_drops_towards_the_targets(spark, kept):
    docs, out, *_ = kept["mixing"]
    times, rows = {}, {r.doc_id: r for r in docs}
    for row in out:
        assert row == rows[row.doc_id]
        times[row.doc_id] = times.get(row.doc_id, 0) + 1
    assert max(times.values()) <= 3 and len(times) < len(rows)
    words = lambda rows: sum(len(r.text.split()) for r in rows)
    assert words(out) == pytest.approx(words(docs), rel=0.1)
    frame = spark.createDataFrame(docs)
    assert times == {r.doc_id: r.times for r in mixing.mix(frame, weights=[5, 2, 1]).collect() if r.times}


def test_tokens_are_those_of_a_public_encoder(kept):
    docs, out, *_ = kept["tokens"]
    ranks = bpe.read_ranks(corpus_pipeline.RANKS)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: plain.encode_ordinary(r.text) for r in docs}
    assert len(out) == len(docs)
    for row in out:
        assert row.exact and row.n_tokens == len(texts[row.doc_id])
        assert bytes(row.ids) == struct.pack(f"<{row.n_tokens}I", *texts[row.doc_id])


def test_tokens_send_back_neither_texts_nor_decoded_bytes(spark):
    docs = spark.createDataFrame([(1, "one two", "en", "a", 7)], "doc_id long, text string, lang string, source string, n_chars long")
    plan = corpus_pipeline.encode_tokens(spark, docs, SF)._jdf.queryExecution().optimizedPlan().toString()
    made = re.search(r"MapInArrow .*?, \[(.*?)\]", plan)[1]
    assert re.findall(r"(\w+)#", made) == ["doc_id", "lang", "source", "ids", "exact"]


def test_workers_give_back_freed_batches_at_the_end_of_every_task(spark, monkeypatch):
    released, frame, tasks = [], type(spark.range(0)), []
    plain = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda self, run, *rest: (tasks.append(run.__qualname__), plain(self, run, *rest))[1])
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(50)
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF)
    assert len(tasks) > 9 and {t.split(".")[0] for t in tasks} == {"releasing"}

    class Pool:
        def release_unused(self):
            released.append(True)

    monkeypatch.setattr(registry.pa, "default_memory_pool", Pool)
    task = registry.releasing(lambda batches: (2 * b for b in batches))([1, 2])
    assert [next(task), next(task)] == [2, 4] and not released
    assert list(task) == [] and released == [True]


def test_run_gives_the_rows_of_the_stages(spark, kept):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, kept["tokens"][1]))


def test_stages_take_nulls_empty_tables_and_repeated_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (None, "the and of to", None, "a", 3), (2, "", "en", "b", 0), (3, "the of", "en", "b", 6)]
    rows += [(3, "the of", "en", "b", 6)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns or name == "tokens"
            left = sorted(map(repr, out.collect()))
            if name in ("personal_data", "tokens"):
                assert len(left) == docs.count()
            elif name == "near_duplicates" and docs.count():
                assert left == sorted(map(repr, docs.dropDuplicates().collect()))
            elif not docs.count():
                assert left == []
            else:
                assert set(left) <= set(map(repr, docs.collect()))


def linked_at_80(rows):
    """The smallest id of the component of every row, from all pairs."""
    sets, found = {d: shingle_set(t) for d, t in rows}, Union()
    ids = sorted(d for d in sets if sets[d])
    for at, a in enumerate(ids):
        for b in ids[:at]:
            common = len(sets[a] & sets[b])
            if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                found.join(a, b)
    return {d: found.root(d) for d in sets}


def test_near_copies_from_80_percent_on_go(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    words = [f"w{i}" for i in range(204)]
    close = [words, words[:80] + ["new"] * 4 + words[84:], words[:100] + ["so", "far"] + words[102:], words[4:] + ["end"] * 9]
    close += [words[:60] + [f"o{n}"] + words[61:120] + [f"p{n}"] + words[121:160] + [f"q{n}"] + words[161:] for n in range(8)]
    more = [(100_000 + n, " ".join(text), "en", "a", 1) for n, text in enumerate(close)]
    docs = docs.union(spark.createDataFrame(more, docs.schema))
    want = linked_at_80([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sum(d != root for d, root in want.items()) > sum(
        not keep for *_, keep in brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]).values()
    )
    out = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert sorted(r.doc_id for r in out.collect()) == sorted(d for d, root in want.items() if d == root)


@pytest.mark.parametrize("sent, most", [(1 << 18, 1 << 24), (0, 1 << 24), (0, 0)])
def test_one_row_of_each_component_stays_whatever_ids_repeat(spark, monkeypatch, sent, most):
    monkeypatch.setattr(minhash, "SENT_ROWS", sent)  # with 0, a filter says which texts are shuffled
    monkeypatch.setattr(minhash, "FILTER_MEMBERS", most)  # with 0, all are
    base, other = " ".join(f"w{i}" for i in range(100)), "a clean text that nothing else resembles"
    rows = [(5, base, "en", "a", 1), (5, other, "en", "a", 1), (3, base + " end", "en", "a", 1)]
    rows += [(7, "said twice by one id", "en", None, 1)] * 3 + [(8, "SAID two ways by one id", "en", "a", 1), (8, "said two ways by one id", None, "a", 1)]
    rows += [(9, "", "en", "a", 0), (None, base, "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    one, again = (
        sorted(map(repr, corpus_pipeline.drop_near_duplicates(spark, d, SF).collect())) for d in (docs, docs.repartition(3, "text"))
    )
    assert one == again and len(one) == 6
    found = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()]
    assert {(5, other), (3, base + " end"), (7, "said twice by one id"), (9, ""), (None, base)} < set(found)
    assert sum(d == 8 for d, _ in found) == 1
