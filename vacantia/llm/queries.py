"""One query per operator, each over its whole table and with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from vacantia.llm import ann, bpe, conversations, imatch, licenses, lm, minhash, mixing, pii, quality, search, sharding, warc
from vacantia.llm.registry import query, table
from vacantia.session import work_dir

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@query()
def op1_byte_bpe(spark, sf):
    """Token count and digests of every text, encoded and decoded again."""
    docs = table(spark, sf, "documents", "doc_id", "text")
    both = bpe.encode(docs, RANKS, public_tokenizers.PATTERN, decoded="decoded", keep=["doc_id"])
    return both.select(
        "doc_id",
        bpe.token_count().alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("""
    WITH p AS (
        SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
    d AS (
        SELECT page_id, payload_bytes, sha256(html) AS payload_digest FROM p),
    f AS (
        SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY ALL)
    SELECT d.page_id, d.payload_bytes, d.payload_digest,
        CASE WHEN first_id IS NOT NULL AND first_id IS DISTINCT FROM d.page_id THEN 'revisit' ELSE 'response' END
            AS record_type,
        CASE WHEN first_id IS DISTINCT FROM d.page_id THEN first_id END AS refers_to
    FROM d LEFT JOIN f USING (payload_digest)
""")
def op2_warc(spark, sf):
    """Every page written to an archive, found again by its address through the index, and read."""
    pages = table(spark, sf, "pages", "page_id", "url", "html")
    folder = work_dir(spark, "warc")
    warc.write_archives(pages, f"{folder}/archives")
    warc.build_index(spark, f"{folder}/archives", f"{folder}/index")
    captures = warc.lookup(pages.select(warc.url_key(F.col("url")).alias("key")), f"{folder}/index")
    return warc.read_records(captures, f"{folder}/archives", payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("""
    WITH v AS (
        SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0
            AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
            AND len([x FOR x IN embedding IF x <> 0]) > 0),
    p AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
        FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 20 = 0),
    r AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
""")
def op3_nearest(spark, sf):
    """The 20 nearest of every twentieth vector among all others."""
    vectors = table(spark, sf, "embeddings", "vec_id", "embedding")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


@query(licenses.scan_sql("documents"))
def op4_licenses(spark, sf):
    """Licence sentences and licences of every document."""
    return licenses.scan(table(spark, sf, "documents", "doc_id", "text")).select("doc_id", "sentences", "licences")


@query()
def op5_imatch(spark, sf):
    """Fingerprints of every text, of it with its second half exchanged, and their likeness."""
    docs = table(spark, sf, "documents", "doc_id", "text")
    docs = docs.withColumn("text", F.coalesce("text", F.lit("")))
    lexicon = imatch.lexicon(docs)
    rows = imatch.with_next(imatch.fingerprint(docs, lexicon, "text", "own"), "doc_id", ["text", "own"])
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    kept = F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int"))
    new = F.coalesce(F.substring(F.col("next.text"), F.lit(1), half), F.lit(""))
    rows = rows.withColumn("edited", F.concat(kept, new))
    rows = imatch.fingerprint(rows.drop("text"), lexicon, "edited", "changed").withColumn("next", F.col("next.own"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        imatch.readable("own").alias("fingerprint"),
        imatch.readable("changed").alias("edited_fingerprint"),
        imatch.likeness("own", "changed").alias("near_edited"),
        F.coalesce(imatch.likeness("own", "next"), F.lit(0.0)).alias("near_next"),
    )


@query()
def op6_quality(spark, sf):
    """Every document with its importance weight and whether resampling keeps it."""
    docs = table(spark, sf, "documents", "doc_id", "text")
    model = quality.fit(docs, table(spark, sf, "labels", "doc_id", "quality"))
    return quality.resample(docs, model, keep=["doc_id"])


@query()
def op7_pii(spark, sf):
    """Counts and places of personal data in every text."""
    rows = pii.find(table(spark, sf, "documents", "doc_id", "text"), keep=["doc_id"])
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    count = {f"n_{kind}": F.size(of(kind)).cast("long") for kind in pii.BASE}
    place = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    joined = lambda spans: F.array_join(F.transform(spans, place), ",")
    digests = {"base_sha256": F.sha2(joined(of(*pii.BASE)), 256), "spans": joined(F.col("spans"))}
    return rows.withColumns({**count, **digests})


@query()
def op8_minhash(spark, sf):
    """Every document with the component of near-duplicates that it belongs to."""
    return minhash.near_duplicates(table(spark, sf, "documents", "doc_id", "text"))


@query()
def op9_mixing(spark, sf):
    """All documents with the words that a mix of their sources takes of each."""
    docs = table(spark, sf, "documents", "doc_id", "text", "source")
    return mixing.mix(docs, weights=[5, 2, 1]).select("doc_id", "size", "source_size", "target", "taken")


@query()
def op10_hash_tree(spark, sf):
    """All documents in 16 shards, with their place there, and the shard they have when one is added."""
    docs = table(spark, sf, "documents", "doc_id", "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    rows = sharding.assign(rows, sharding.layout(16))
    return sharding.number(sharding.assign(rows, sharding.layout(17), shard="grown_shard"))


TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


@query(f"""
    WITH t AS (
        SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(text, {LOWER}), '{TERMS}') AS terms
        FROM documents),
    d AS (SELECT row, doc_id, len(terms) AS n FROM t WHERE len(terms) > 0),
    s AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS total FROM d),
    f AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM t) GROUP BY ALL),
    w AS (
        SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT) AS w
        FROM (SELECT term, count(*) AS df FROM f GROUP BY term), s),
    i AS (SELECT DISTINCT item_id, text FROM benchmark),
    q AS (
        SELECT item_id, text, term, count(*) AS times
        FROM (SELECT *, unnest(regexp_extract_all(translate(text, {LOWER}), '{TERMS}')) AS term FROM i) GROUP BY ALL),
    p AS (
        SELECT q.item_id, q.text, d.row, d.doc_id, CAST(sum(times * w * ((1000000000 * tf)
            // (1000 * tf + 8 * (100 - 75 + ((75 * n * docs) // total))))) AS BIGINT) AS score
        FROM q JOIN w USING (term) JOIN f USING (term) JOIN d USING (row), s GROUP BY ALL),
    r AS (
        SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS rank
        FROM p WHERE score > 0)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10
""")
def op11_search(spark, sf):
    """The ten best documents of all for every benchmark item."""
    docs, items = table(spark, sf, "documents", "doc_id", "text"), table(spark, sf, "benchmark", "item_id", "text")
    return search.best_documents(docs, items)


def _repair_sql() -> str:
    """The least cost and audit of each state, from the last row to the first, as texts that sort like both."""
    add = lambda cost, edits, of: f"lpad(CAST(CAST({of}[1:12] AS BIGINT) + {cost} AS VARCHAR), 12, '0') || '{edits}' || {of}[13:]"
    zero = lambda cost, edits="": f"'{cost:012d}{edits}'"
    following = {0: 2, 1: 2, 2: 3, 3: 2}  # the state after a user's row, or after user the assistant's
    kept = {0: (("s", 1), ("u", 2)), 1: (("u", 2),), 2: (("a", 3),), 3: (("u", 2),)}
    row, insert = [], []
    for state in range(4):
        ways = [add(3, "D", f"b.v{state}")]
        ways += [f"CASE WHEN free AND initial = '{i}' THEN {add('cut', 'K', f'b.v{to}')} END" for i, to in kept[state]]
        ways += [f"CASE WHEN free THEN {add('2 + cut', 'R', f'b.v{following[state]}')} END"]
        row.append(f"least({', '.join(ways)}) AS w{state}")
        once, twice = following[state], following[following[state]]
        insert.append(f"least(w{state}, {add(2, 'I', f'w{once}')}, {add(4, 'II', f'w{twice}')}) AS v{state}")
    return f"""
    WITH RECURSIVE codes AS (
        SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
            lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS c FROM range(256) r(i))),
    hashed AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(
                string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                lambda x: ascii(x)::UBIGINT)),
                lambda c, x: xor(c >> 8, t[CAST((xor(c, x) & 255) + 1 AS BIGINT)])), 4294967295::UBIGINT) % 20 AS fate
        FROM conversations, codes),
    harmed AS (
        SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
            CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
            unnest(CASE WHEN fate = 3 THEN [1, 2] ELSE [1] END) AS time
        FROM hashed WHERE fate <> 0),
    placed AS (
        SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS inner_text, role[1:1] AS initial,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(role || chr(0) || text), time) AS place
        FROM harmed),
    marked AS (
        SELECT *, CASE WHEN inner_text = '' THEN 1
            WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 2
            WHEN inner_text[-1:] NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
            lead(initial) OVER (PARTITION BY conv_id ORDER BY place) AS following
        FROM placed),
    totals AS (
        SELECT conv_id, count(*) AS n, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
            count(*) FILTER (fault = 3) AS truncated,
            count(*) FILTER (following IS NOT NULL AND initial || following NOT IN ('su', 'ua', 'au')) AS illegal,
            coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps
        FROM marked GROUP BY conv_id),
    best AS (
        SELECT conv_id, n AS place, {zero(0)} AS v0, {zero(4, "II")} AS v1, {zero(2, "I")} AS v2, {zero(0)} AS v3 FROM totals
        UNION ALL
        SELECT conv_id, place, {", ".join(insert)} FROM (
            SELECT b.conv_id, b.place - 1 AS place, {", ".join(row)}
            FROM (SELECT *, fault IN (0, 3) AS free, CASE WHEN fault = 3 THEN 1 ELSE 0 END AS cut FROM marked) m
            JOIN best b ON m.conv_id IS NOT DISTINCT FROM b.conv_id AND m.place = b.place)),
    found AS (SELECT conv_id, CAST(v0[1:12] AS BIGINT) AS cost, v0[13:] AS audit FROM best WHERE place = 0),
    edits AS (SELECT conv_id, audit, unnest(range(1, len(audit) + 1)) AS no FROM found),
    steps AS (
        SELECT conv_id, no, audit[no] AS edit, len(replace(audit[1:no], 'I', '')) AS place,
            len(replace(audit[1:no], 'D', '')) AS put, len(audit) - len(ltrim(audit, 'D')) + 1 AS head
        FROM edits),
    said AS (
        SELECT s.*, m.role, m.text, m.initial,
            max(CASE WHEN no = head AND edit = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY s.conv_id) AS opened
        FROM steps s LEFT JOIN marked m ON m.conv_id IS NOT DISTINCT FROM s.conv_id AND m.place = s.place AND edit <> 'I'),
    texts AS (
        SELECT conv_id, string_agg(CASE edit WHEN 'K' THEN role ELSE
            CASE WHEN (put - opened) % 2 = 1 THEN 'user' ELSE 'assistant' END END
            || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY no) AS repaired
        FROM said WHERE edit <> 'D' GROUP BY conv_id)
    SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
        coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
        coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c
    LEFT JOIN totals t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN found f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN texts x ON x.conv_id IS NOT DISTINCT FROM c.conv_id
    """


@query(_repair_sql())
def op13_repair(spark, sf):
    """All conversations damaged, and what it takes to repair them."""
    given = table(spark, sf, "conversations", "conv_id", "turn", "role", "text")
    return conversations.repair_report(given, conversations.damaged(given))


@query()
def op12_lm(spark, sf):
    """All documents scored by a model of nine in ten of them."""
    docs = table(spark, sf, "documents", "doc_id", "text")
    remainder = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10
    return lm.score(docs, remainder == 0)
