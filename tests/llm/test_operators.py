"""Each operator against brute force, on texts that are null, empty, odd, long, repeated."""

import hashlib
import zlib
from collections import Counter

import compare
import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tariffbook.llm import (
    chat,
    common,
    decontaminate,
    digests,
    id_shards,
    importance,
    licenses,
    packing,
    queries,
    simhash,
    token_counts,
    url_filters,
    wordhash,
)

SF = "/root/testdata/sf0.001"
WORD, BYTE, PIECE = (
    public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model")
)


def pairs(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]


def test_url_filters_equal_their_sql(spark):
    with compare.duck(SF) as connection:
        name = "op1_url_filters"
        assert compare.differences(queries.QUERIES[name](spark, SF), connection, queries.SQL[name]) == []


def test_url_filters_cases(spark):
    urls = [
        None, "", "no scheme/en/", "http://X.Example.COM/en/a?b", "http://www.example.com/en/", "http://example.com",
        "http://a.net/fr/x", "http://a.net/fr", "http://a.org/en/", "http://spam-farm.a.org", "http://notspam-farm.a.org/",
        "http://a.org/?u=/cgi-bin/x", "http://example.com/english/", "http://a.com?/en/",
        "http://a.org?to=b.net/es/x", "http://a.org#b.com/", "http://a.org?b.spam-farm.net", "http://a.net/es",
    ]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] * 2, "page_id int, url string, host string")
    judged = url_filters.judge(pages, url_filters.POLICY + url_filters.PATTERNS).collect()
    found = {r["page_id"]: (r["matched"], r["verdict"]) for r in judged}
    assert len(judged) == 2 * len(urls)
    assert [found[i][0] for i in range(len(urls))] == [
        None, None, None, "example.com/en/", "www.example.com/en/", None, "net/fr/", None, None, "||spam-farm.", None,
        "/cgi-bin/", "com/", None, None, None, None, None,
    ]
    assert url_filters.judge(pages.limit(0), url_filters.POLICY).count() == 0
    open_rule = [url_filters.Rule("any", "*ngl*")]  # no whole token: tried on every url
    assert url_filters.judge(pages, open_rule).where("verdict = 'block'").count() == 2


def test_kth_largest(spark):
    rng = np.random.default_rng(1)
    values = [float(v) for v in np.concatenate([rng.normal(size=6000), np.full(500, 0.25), [1e6, -1e6]])]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ordered = sorted(values, reverse=True)
    assert all(common.kth_largest(df, "v", k) == ordered[k - 1] for k in (1, 2, 2700, len(values)))
    assert common.kth_largest(df, "v", len(values) + 1) is None


def test_importance(spark, docs, empty):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(8, 28)] + [(6, 0, 0)], "doc_id long, quality int, toxic int")
    judged = {r["doc_id"]: r for r in importance.resample(docs, labels).collect()}
    assert len(judged) == docs.select("doc_id").distinct().count()
    assert judged[0]["log_ratio"] == 0.0
    assert judged[6]["log_ratio"] == min(r["log_ratio"] for r in judged.values())
    assert not judged[6]["keep"]
    unlabelled = importance.resample(docs, labels.limit(0))
    assert unlabelled.where("keep").count() == docs.count()
    assert importance.resample(empty, labels).count() == 0


def test_importance_of_the_worst_passage(spark):
    """A few bad words amid many good ones go, though the whole text is as likely as any other."""
    rng, bad = np.random.default_rng(5), range(300, 400)
    plain = [" ".join(f"w{w}" for w in rng.integers(0, 300, 400)) for _ in range(400)]
    rows = [(i, f"{t} you foul vile swine {plain[i - 300]} foul swine vile" if i in bad else t) for i, t in enumerate(plain)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(300)], "doc_id long, quality int, toxic int")
    judged = importance.resample(spark.createDataFrame(rows, "doc_id long, text string"), labels).collect()
    kept = {r["doc_id"] for r in judged if r["keep"]}
    assert len(kept - set(bad)) >= 290
    assert len(kept & set(bad)) <= 5
    texts = pa.array(["", "a " * 20 + "b", "b", ""])
    values = np.concatenate([np.ones(20), [-3.0], [2.0]])
    assert importance.worst_passages(values, wordhash.words(texts)[1], 4).tolist() == [0.0, 1.0, 2.0, 0.0]


def test_packing(docs, empty):
    tokenizer = Tokenizer.from_file(WORD)
    expected = Counter(
        (i, np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes()) for i, t in pairs(docs)
    )
    rows = packing.pack_documents(docs).collect()
    by_doc, by_window = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_window.setdefault(r["sequence_id"], []).append(r)
    for doc, mine in by_doc.items():
        times = sum(n for (i, _), n in expected.items() if i == doc)
        assert Counter(r["start"] for r in mine).most_common(1)[0][1] <= times
        whole = next(ids for (i, ids) in expected if i == doc)
        assert all(r["ids"] == whole[4 * r["start"] : 4 * (r["start"] + r["length"])] for r in mine)
        assert sum(r["length"] for r in mine) == times * len(whole) // 4
    for window in by_window.values():
        at = 0
        for r in sorted(window, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    assert sum(sum(r["length"] for r in w) < 2048 for w in by_window.values()) <= docs.rdd.getNumPartitions()
    assert packing.pack_documents(empty).count() == 0


def test_simhash(docs, empty):
    def brute(text):
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        for space in "\t\n\x0b\x0c\r":
            lowered = lowered.replace(space, " ")
        words = [w for w in lowered.split(" ") if w]
        shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    rows = pairs(docs)
    prints = [brute(t) for _, t in rows]
    group = list(range(len(rows)))
    for _ in rows:
        for a in range(len(rows)):
            near = [b for b in range(len(rows)) if (prints[a] ^ prints[b]).bit_count() <= 3]
            low = min(group[b] for b in near)
            for b in near:
                group[b] = low
    names = {g: min((rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None), default=None) for g in group}
    expected = Counter((rows[i][0], f"{prints[i]:016x}", names[group[i]]) for i in range(len(rows)))
    assert Counter(tuple(r) for r in simhash.near_duplicates(docs).collect()) == expected
    assert simhash.near_duplicates(empty).count() == 0


def test_simhash_index_finds_every_pair(spark):
    """A dense ball of fingerprints, more than a part holds, against all pairs."""
    rng = np.random.default_rng(4)
    prints = {0}
    while len(prints) < 1500:
        x = 0
        for bit in rng.choice(20, rng.integers(1, 9), replace=False):
            x |= 1 << int(bit)
        prints.add(x)
    prints = [p | int(rng.integers(0, 3)) << 60 for p in prints]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    linked = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"))
    root = {p: p for p in signed}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for r in linked.collect():
        assert ((r["a"] ^ r["b"]) & ((1 << 64) - 1)).bit_count() <= 64
        root[find(r["a"])] = find(r["b"])
    array = np.array(prints, np.uint64)
    for i, p in enumerate(signed):
        for j in np.flatnonzero(np.bitwise_count(array ^ array[i]) <= 3):
            assert find(p) == find(signed[int(j)])


def test_token_counts(docs, empty):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    expected = Counter((i, len(t.encode()), len(model.encode(t)), len(model.encode(t)) > 4096) for i, t in pairs(docs))
    assert Counter(tuple(r) for r in token_counts.count_tokens(docs, PIECE).collect()) == expected
    assert token_counts.count_tokens(empty, PIECE).count() == 0


def test_decontamination(spark, docs, empty, texts):
    item, other = " ".join(texts[11].split()[4000:4040]), " ".join(texts[12].split()[5:30])
    bench = spark.createDataFrame([(1, item), (2, other), (3, ""), (4, None), (5, "alone " * 3)], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.decontaminate(docs, bench).collect()}
    assert found == {(11, 1), (12, 2)}
    words = item.split()
    changed = spark.createDataFrame([(7, "x y z " * 30 + " ".join(w for i, w in enumerate(words) if i % 9))], "doc_id long, text string")
    assert decontaminate.decontaminate(changed, bench).select("item_id").collect()[0][0] == 1
    spoken = "Été où l'âme naïve — «déçue» — rêva d'îles, près du Øresund à l'aube … écoutait la mer qui chantait"
    signs = "東京の天気は明日から晴れるでしょう"
    asked = spark.createDataFrame([(1, spoken), (2, signs)], "item_id long, text string")
    written = [(1, f"A B. {spoken.upper()}! C"), (2, spoken.replace("«", "“ ").replace("—", "")), (3, f"前略。{signs}。以上"), (4, "où à la mer")]
    held = decontaminate.decontaminate(spark.createDataFrame(written, "doc_id long, text string"), asked)
    assert {(r["doc_id"], r["item_id"]) for r in held.collect()} == {(1, 1), (2, 1), (3, 2)}
    assert decontaminate.decontaminate(docs, bench.limit(0)).count() == 0
    assert decontaminate.decontaminate(empty, bench).count() == 0


def test_chat(spark):
    said = "</s>[INST] ok [/INST]<|x|>\\"
    rows = [(1, 0, "system", "be kind"), *((1, t, ("assistant", "user")[t % 2], f"{said} {t} " * (t % 7 * 20)) for t in range(1, 400))]
    rows += [(2, None, None, None), (2, 0, "a|>b", said), (2, 0, "a|>b", said), (None, 1, "assistant", "no id")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("n", F.lit("x"))
    made = chat.windows(turns)
    found = {r["conv_id"]: r for r in chat.digest(made).collect()}
    for conv in (1, 2, None):
        mine = [(r or "", t or "") for c, _, r, t in rows if c == conv]
        whole = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in mine).encode()).hexdigest()
        loss = "".join(t for r, t in mine if r == "assistant")
        row = found[conv]
        assert (row["n_turns"], row["turns_sha256"]) == (len(mine), whole)
        assert (row["loss_chars"], row["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    later = made.where("conv_id = 1 AND window > 1").collect()
    assert later
    assert all(chat.read_turns(r["text"])[0] == ("system", "be kind") for r in later)
    assert chat.digest(chat.windows(turns.limit(0))).count() == 0


def test_licenses(spark, empty):
    notice = dict(licenses.TEMPLATES)["GPL-3.0"]
    near = "This work is  LICENSED under the GNU General Public License version 3"
    rows = [(1, f"text\n{notice}\nmore"), (2, near), (3, None), (4, ""), (5, "license"), (6, "a b\n" * 50), (2, near), (None, notice)]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    # In document 1 both the line and the block of lines around it are like the notice.
    assert Counter(r["doc_id"] for r in found.where("license = 'GPL-3.0'").collect()) == {1: 2, 2: 2, None: 1}
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.8)
    assert Counter(tuple(r) for r in found.collect()) == Counter((i, *m) for i, t in rows for m in scanner.matches(t or ""))
    assert licenses.scan(empty).count() == 0

    noise = "kara losen, miti the General terdown of this. " * 90
    changed = notice.replace("Foundation", "Group")
    line = f"{noise}{changed} {noise}Licensed under CC BY-NC 4.0. {noise}"
    inside = {m[0]: line[m[2] : m[2] + m[3]] for m in scanner.matches(line)}
    assert inside == {"GPL-3.0": changed.rstrip("."), "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0"}
    assert scanner.matches(noise * 3) == []


def test_id_shards(spark, docs, empty):
    tokenizer = Tokenizer.from_file(BYTE)
    order = sorted(pairs(docs), key=lambda r: (r[0] is not None, r[0]))
    expected, at = {}, 0
    for i, text in order:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        expected.setdefault(i, (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    folder = common.new_path(spark, "test-shards")
    id_shards.write(docs, folder, BYTE)
    found = id_shards.lookup(spark, folder, docs.select("doc_id").unionAll(spark.createDataFrame([(10**9,)], "k long")))
    read = id_shards.slices(spark, folder).withColumn("crc", F.crc32("ids"))
    rows = found.join(read, id_shards.ADDRESS).select("key", "start", "length", "crc").collect()
    assert {r["key"]: tuple(r)[1:] for r in rows} == {k: v for k, v in expected.items() if k is not None}
    assert found.where("key = 1000000000").first()["shard"] is None
    assert id_shards.get(spark, folder, 2) == [*tokenizer.encode("one", add_special_tokens=False).ids, 0]
    none = common.new_path(spark, "test-shards")
    id_shards.write(empty, none, BYTE)
    assert id_shards.lookup(spark, none, docs.select("doc_id")).where("shard IS NOT NULL").count() == 0


def test_id_shards_return_every_row(spark, docs, tmp_path):
    """Repeated ids, with equal and with other texts, and null ids."""
    more = [(9, "another text"), (9, None), (None, "no id"), (None, "no id"), *[(12, "hot")] * 300]
    rows = docs.select("doc_id", "text").unionAll(spark.createDataFrame(more, "doc_id long, text string"))
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    tokenizer, expected, at = Tokenizer.from_file(BYTE), Counter(), 0
    hashed = lambda t: np.array([xxhash.xxh64_intdigest(t.encode(), 42)], np.uint64).view(np.int64)[0]
    ordered = sorted(pairs(rows), key=lambda r: (r[0] is not None, r[0] or 0, hashed(r[1])))
    coded = [(i, np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4")) for i, t in ordered]
    for i, ids in coded:
        expected[i, at, len(ids), zlib.crc32(ids.tobytes())] += 1
        at += len(ids)
    assert Counter(tuple(r) for r in id_shards.op9_id_shards(spark, str(tmp_path)).collect()) == expected
    folder = common.new_path(spark, "test-shards")
    id_shards.write(rows, folder, BYTE)
    found = {r["key"]: r["rows"] for r in id_shards.lookup(spark, folder, rows.select("doc_id")).collect()}
    assert found == {k: n for k, n in Counter(i for i, _ in coded).items() if k is not None}


def test_perfect_hash():
    for n in (1, 2, 3, 50, 3000):
        keys = np.random.default_rng(n).integers(-(10**15), 10**15, n)
        displace, slots = id_shards.build_hash(keys)
        assert sorted(slots) == list(range(n))
        assert (id_shards.find_slots(keys, displace, n) == slots).all()


def test_digests(spark, docs, empty):
    rows = sorted(pairs(docs), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    expected = Counter()
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        n = len(text) // 3
        edited = text[: len(text) - n] + after[:n]
        a, b, c = map(digests.Digest, (text, edited, after))
        expected[i, len(text), hashlib.sha256(edited.encode()).hexdigest(), str(a), str(b), a.likeness(b), a.likeness(c)] += 1
    assert Counter(tuple(r) for r in digests.edited_pairs(docs).collect()) == expected
    assert digests.edited_pairs(docs.where("doc_id = 2")).first()["near_next"] == 1.0
    assert digests.edited_pairs(empty).count() == 0
    assert str(digests.parse(str(digests.Digest("some text")))) == str(digests.Digest("some text"))


def test_pipeline(spark, docs, empty):
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = common.staged(stage(spark, kept, SF), "test")
        assert kept.columns == docs.columns, name
        assert stage(spark, empty, SF).count() == 0
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids.keys() & {8, 9, 10} in ({8}, {10}, set())
    assert ids[None] == 1
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
    assert {r["doc_id"] for r in packed.collect()} == set(ids)


def test_pipeline_rejects_rows(spark, texts, monkeypatch, tmp_path):
    """An id delivered many times, with other texts too, and rows without an id."""
    item = " ".join(texts[11].split()[4000:4040])
    rows = [*[(1, texts[8])] * 5, (1, texts[12]), (None, texts[8]), *[(None, texts[13])] * 2, (None, f"{texts[14]} {item}"), (2, texts[14])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = corpus_pipeline.decontamination(spark, docs, str(tmp_path))
    assert Counter(tuple(r) for r in clean.collect()) == Counter(r for r in rows if item not in r[1])
    once = corpus_pipeline.near_duplicates(spark, clean, str(tmp_path))
    assert Counter(tuple(r) for r in once.collect()) == Counter([(1, texts[8]), (1, texts[12]), (None, texts[13]), (2, texts[14])])
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    judged = lambda docs, *_, row: docs.select(F.col(row).alias("row"), F.col("text").startswith(texts[12][:40]).alias("keep"))
    monkeypatch.setattr(importance, "resample", judged)
    assert [tuple(r) for r in corpus_pipeline.quality(spark, docs, str(tmp_path)).collect()] == [(1, texts[12])]


def test_decontamination_of_short_and_equal_items(spark, texts):
    """Items under eight words are found as they stand and not otherwise; equal items are rows of their own."""
    words = texts[11].split()
    long, short, gap = " ".join(words[30:60]), " ".join(words[100:107]), " ".join(words[100:103] + words[104:107])
    bench = [(1, long), (2, long), (None, long), (3, short), (4, gap), (5, words[7]), (6, f"{words[100]} unheard"), (7, "")] + [(8, short)] * 3
    bench = spark.createDataFrame(bench, "item_id long, text string").repartition(4)
    docs = spark.createDataFrame([(1, texts[11]), (1, texts[11]), (2, f"x {short.upper()}!"), (3, "x"), (None, long)], "doc_id long, text string")
    found = Counter((r["doc_id"], r["item_id"]) for r in decontaminate.decontaminate(docs, bench).collect())
    plain = [w.strip(",.") for w in (words[7], *short.split(), "", *long.split())]
    own = {1} | {d for d, of in ((2, plain[1 : plain.index("")]), (None, plain[plain.index("") :])) if plain[0] in of}
    expected = Counter({(1, i): 2 for i in (1, 2, None, 3)} | {(1, 8): 6, (2, 3): 1, (2, 8): 3} | {(None, i): 1 for i in (1, 2, None)})
    expected += Counter({(d, 5): 2 if d == 1 else 1 for d in own})
    assert found == expected
    fewer = decontaminate.decontaminate(docs, bench, least=8).select("item_id").distinct().collect()
    assert {r["item_id"] for r in fewer} == {1, 2, None}


def test_fit_sample_is_bounded_and_fixed(spark, monkeypatch):
    """By different rows, whatever their ids, in any order."""
    monkeypatch.setattr(decontaminate, "FIT_DOCS", 50)
    rows = [(4, f"text {i}") for i in range(600)] + [(None, "copy")] * 400 + [(i, "copy") for i in range(20)]
    chosen = []
    for seed in (1, 2):
        order = np.random.default_rng(seed).permutation(len(rows))
        df = spark.createDataFrame([rows[k] for k in order], "doc_id long, text string").repartition(3 * seed)
        chosen.append(Counter(tuple(r) for r in decontaminate.fit_sample(df).collect()))
    assert chosen[0] == chosen[1]
    assert sum(chosen[0].values()) == len(chosen[0]) == 50


def test_candidates_are_those_of_brute_force_cosines(spark):
    """Of windows whose TF-IDF cosine with an item reaches the bound, at least nine in ten are candidates."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rng, items, texts = np.random.default_rng(3), [], []
    pool = [t.split() for t in (r["text"] for r in docs.collect()) if len(t.split()) > 150]
    for share in (0.0, 0.2, 0.4):
        for size in (10, 25, 60):
            for _ in range(6):
                source = pool[rng.integers(len(pool))]
                at = int(rng.integers(0, len(source) - size))
                items.append(" ".join(source[at : at + size]))
                other = pool[rng.integers(len(pool))]
                copy = [other[rng.integers(len(other))] if rng.random() < share else w for w in source[at : at + size]]
                place = int(rng.integers(0, len(other)))
                texts.append(" ".join([*other[:place], *copy, *other[place:]]))
    arrow = pa.array(items)
    idf = decontaminate.weights(docs)
    made = decontaminate.Items(list(range(len(items))), arrow, idf, decontaminate.latent_basis(decontaminate.fit_sample(docs), arrow, idf))
    hashes, number = decontaminate.words_of(pa.array(texts))
    found = {(doc, i, low) for doc, i, low, _, _ in decontaminate.candidates(hashes, number, made)}
    wanted = set()
    for doc in range(len(texts)):
        first, own = int(np.searchsorted(number, doc)), hashes[number == doc]
        for span, numbers in made.by_span.items():
            step, size = span // 2 * decontaminate.BLOCK, span * decontaminate.BLOCK
            for low in range(0, len(own), step):
                window = np.bincount(decontaminate.terms_of(own[low : low + size]), minlength=decontaminate.TERMS)
                weight = np.sqrt((window * made.square).sum())
                for i in numbers:
                    item = np.bincount(decontaminate.terms_of(np.array(made.words[i], np.uint64)), minlength=decontaminate.TERMS)
                    cosine = (window * item * made.square).sum() / (weight * np.sqrt((item * made.square).sum()))
                    if cosine >= decontaminate.COSINE:
                        wanted.add((doc, i, first + low))
    assert len(wanted) > 40
    assert len(wanted & found) >= 0.9 * len(wanted)


def test_windows_keep_to_their_budget_of_tokens(spark):
    """Real tokens: new turns of a window come to less than two cells, but for a single longer turn."""
    rng, tokenizer = np.random.default_rng(8), Tokenizer.from_file(BYTE)
    rows = [(c, t, ("user", "assistant")[t % 2], "wörd naïve 東京 " * int(rng.integers(0, 60))) for c in range(4) for t in range(60)]
    rows += [(9, 0, "system", "be brief"), (9, 1, "user", "x y z " * 900), (9, 2, "assistant", "short")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for r in chat.windows(turns, BYTE).collect():
        pieces = [p + chat.END for p in r["text"].split(chat.END)[:-1]]
        sizes = [len(tokenizer.encode(p, add_special_tokens=False).ids) for p in pieces]
        new, repeated = sizes[r["n_repeated"] :], sizes[: r["n_repeated"]]
        assert new
        assert sum(new) < 2 * chat.CELL or len(new) == 1
        assert sum(repeated) <= chat.HISTORY + sizes[0]
