"""The other queries against plain implementations, an exact round trip or held-out accuracy."""

import collections
import hashlib
import random
import re
import struct
import zlib

import numpy as np
import pytest

from carestrata.llm.queries import llm_queries, tokenizer_path


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def plain_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        total = sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits)))
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_base_spans_of_random_texts():
    from carestrata.llm.pii import KINDS, base_spans

    pick = random.Random(1)
    for _ in range(4000):
        text = "".join(pick.choice("a1@.-+ 23()%b9é") for _ in range(pick.randint(0, 40)))
        assert [(KINDS[k], a, b) for k, a, b in base_spans(text)] == plain_spans(text)


def test_personal_data(spark, sf_dir, documents):
    found = llm_queries()["op2_bootstrapped_personal_data"](spark, sf_dir).collect()
    assert len(found) == len(documents)
    for row in found:
        spans = plain_spans(documents[row["doc_id"]]["text"] or "")
        told = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert row["base_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(s[0] == k for s in spans) for k in ("email", "ip", "card", "phone")]
        assert set(filter(None, told.split(","))) <= set(row["spans"].split(","))


def test_patterns_discover_unseen_values(spark):
    from carestrata.llm.pii import find_personal_data

    rows = [(i, f"words here number {i} call hotline +1 (555) 010-{1000 + i} now") for i in range(10)]
    rows += [(100, "please call hotline 0171 555 1234 now"), (101, "an ordinary 0171 555 9999 number")]
    rows += [(200 + i, f"the order 77{i}1 555 123{i} came") for i in range(9)] + [(300, "the order +1 555 010 3333")]
    found = {r["doc_id"]: r for r in find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [tuple(s) for s in found[100]["found"]] == [(3, 20, 33)] and not found[101]["found"]
    assert not any(found[200 + i]["found"] for i in range(9)) and len(found[0]["base"]) == 1


def test_language(spark, sf_dir, documents):
    found = llm_queries()["op4_byte_recurrent_language"](spark, sf_dir).collect()
    held = [r for r in found if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in documents if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r["lang_pred"] == documents[r["doc_id"]]["lang"] for r in held]) >= 0.9


def test_backpropagation_matches_differences():
    from carestrata.llm import langid

    rng = np.random.default_rng(0)
    make = lambda *s: rng.normal(0, 0.5, s)
    unit = langid.Direction(make(256, 3 * langid.HIDDEN), make(langid.HIDDEN, 2 * langid.HIDDEN), make(langid.HIDDEN, langid.HIDDEN))
    rows, out = rng.integers(0, 4, (5, 6)), make(6, 5, langid.HIDDEN)
    loss = lambda: float((unit.run(rows) * out).sum())
    keep = []
    unit.run(rows, keep)
    for weights, grad in zip((unit.table, unit.gates, unit.candidate), unit.back(rows, keep, out.astype(np.float32))):
        i, j = (rows[0, 0], 3) if weights is unit.table else (2, 3)
        step = 1e-2
        weights[i, j] += step
        up = loss()
        weights[i, j] -= 2 * step
        down = loss()
        weights[i, j] += step
        assert (up - down) / (2 * step) == pytest.approx(grad[i, j], rel=0.05, abs=0.02)


def plain_fingerprint(text):
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, bits):
    parent = {i: i for i in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash(spark, sf_dir, documents):
    found = llm_queries()["op5_deletion_variant_simhash"](spark, sf_dir).collect()
    prints = {i: plain_fingerprint(r["text"]) for i, r in documents.items()}
    assert {r["doc_id"]: int(r["fingerprint"], 16) for r in found} == prints
    assert {r["doc_id"]: r["component_id"] for r in found} == plain_components(prints, 2)


@pytest.mark.parametrize("bits", [1, 2])
def test_links_of_crowded_fingerprints(spark, bits):
    from carestrata.llm.components import connected_components
    from carestrata.llm.simhash import links

    pick = random.Random(4)
    prints = {0}
    for _ in range(6):  # walks of small steps crowd some keys
        at = pick.getrandbits(64)
        for _ in range(40):
            for _ in range(pick.randint(1, 3)):
                at ^= 1 << pick.randint(0, 63)
            prints.add(at)
    signed = [p - (1 << 64) if p >> 63 else p for p in sorted(prints)]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = {r["u"]: r["component"] for r in connected_components(links(frame, bits)).collect()}
    want = plain_components({p: p & (2**64 - 1) for p in signed}, bits)
    assert {p: found.get(p, p) for p in signed} == want


def plain_repeats(texts, length=200):
    data = [(t or "").encode() for t in texts]
    counts = collections.Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        covered = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if counts[d[i : i + length]] > 1:
                covered[i : i + length] = b"\1" * length
        kept = bytes(x for x, y in zip(d, covered) if not y)
        runs = sum(1 for i in range(len(d)) if covered[i] and not (i and covered[i - 1]))
        out.append((len(d), len(d) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_ranks_of_small_alphabets():
    from carestrata.llm.suffix import suffix_ranks

    pick = random.Random(3)
    for _ in range(200):
        letters = pick.choice([b"ab", b"abc", b"a", b"abcdefgh"])
        sets = [[bytes(pick.choices(letters, k=pick.randint(1, 14))) for _ in range(pick.randint(1, 4))] for _ in range(pick.randint(1, 5))]
        strings = [s for p in sets for s in p]
        text = np.frombuffer(b"".join(strings), dtype=np.uint8).astype(np.int64)
        string = np.repeat(np.arange(len(strings)), [len(s) for s in strings])
        ranks = iter(suffix_ranks(text, string, np.repeat(np.arange(len(sets)), [len(p) for p in sets])[string]))
        for p in sets:
            suffixes = sorted(((s[i:], next(ranks)) for s in p for i in range(len(s))), key=lambda x: x[0])
            for (a, x), (b, y) in zip(suffixes, suffixes[1:]):
                assert x < y if a < b else x == y


def test_repeats(spark, sf_dir, documents):
    found = {r["doc_id"]: tuple(r)[1:] for r in llm_queries()["op6_lyndon_group_repeats"](spark, sf_dir).collect()}
    ids = sorted(documents)
    assert [found[i] for i in ids] == plain_repeats([documents[i]["text"] for i in ids])


def test_repeats_of_one_crowded_passage(spark):
    from carestrata.llm.suffix import MAX_CONTEXTS, remove_repeats

    pick = random.Random(5)
    draw = lambda letters, n: "".join(pick.choices(letters, k=n))
    passage = draw("abcdefghij ", 260)
    texts = ["a" * 1000, None, "", "xyz" * 300, passage, passage, passage[:230] + "zz", "q" * 199, passage[10:209], passage[10:210], "é" * 150]
    texts += [draw("klmno", pick.randint(0, 90)) + passage + draw("uvw", 60) for _ in range(2 * MAX_CONTEXTS)]
    rows = [(i, t) for i, t in enumerate(texts)]
    found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found[i] for i in range(len(texts))] == plain_repeats(texts)


def test_token_records(spark, sf_dir, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    start, want = 0, []
    for i in sorted(documents):
        ids = tokenizer.encode(documents[i]["text"] or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    found = sorted(tuple(r) for r in llm_queries()["op7_framed_token_records"](spark, sf_dir).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert found == want


def test_words_are_encoded_as_in_the_whole_text():
    from carestrata.llm.records import Encoder

    pick, encoder = random.Random(2), None
    encoder = Encoder(tokenizer_path())
    parts = ["a", "it's", " ", "  ", "\n", "\n\n", "\t", "<|endoftext|>", "é", "漢字", "\x1d", "\x85", "\xa0", "12", "...", ",", "a.b", "a\u0301%%%", "²;", "​", "\U0001f600"]
    texts = ["".join(pick.choices(parts, k=pick.randint(0, 12))) for _ in range(600)]
    assert encoder.encode(texts) == encoder.whole(texts)


def test_frames_and_their_checksums():
    from carestrata.llm.records import crc32c, frames, read_frames

    assert crc32c([b"123456789", b""]).tolist() == [0xE3069283, 0]
    payloads = [random.Random(n).randbytes(n) for n in (0, 1, 3, 4, 255, 256, 257, 5000)]
    data = b"".join(frames(payloads))
    assert [p for _, p in read_frames(data)] == payloads
    for broken in (data[:-1], data[:40] + bytes([data[40] ^ 1]) + data[41:]):
        with pytest.raises(ValueError):
            read_frames(broken)


def test_index_finds_records(spark, sf_dir):
    from carestrata.llm.common import open_store, table
    from carestrata.llm.records import INDEX_ENTRY, read_frames, write_records

    folder = write_records(table(spark, sf_dir, "documents"), tokenizer_path(), shard_bytes=100_000)
    store, path = open_store(folder)
    read = lambda name: store.open_input_stream(f"{path}/{name}", compression=None).read()
    data = read("data-000001.rec")
    entries = list(struct.iter_unpack(INDEX_ENTRY, read("data-000001.idx")))
    assert [(e[1], struct.unpack_from("<q", p)[0]) for e, (_, p) in zip(entries, read_frames(data))] == [(o, e[0]) for e, (o, _) in zip(entries, read_frames(data))]
    assert len(entries) == len(read_frames(data))


def test_arc_versions():
    from carestrata.llm.arc import arc_head, arc_record, converted, parse_arc, parse_warc

    for version in (1, 2):
        head, one = arc_head(version, "x.arc"), arc_record(version, "x.arc", 0, "http://a b/", b"HTTP/1.1 200 OK\r\n\r\nhello\n\nURL 1")
        ((offset, fields, content),) = parse_arc(iter([(0, head), (9, one)]))
        assert (offset, fields["URL"], fields["Archive-length"], content[-5:]) == (len(head), "http://a%20b/", "31", b"URL 1")
        headers, block = parse_warc(converted("x", 9, fields, content, None))
        assert headers["WARC-Date"] == "2004-02-29T12:34:56Z" and headers["WARC-Type"] == "response" and block == content
        headers, block = parse_warc(converted("x", 9, fields, content, "abc"))
        assert headers["WARC-Refers-To"] == "<urn:uuid:abc>" and block == b"HTTP/1.1 200 OK\r\n\r\n"
        with pytest.raises(ValueError):
            list(parse_arc(iter([(0, head), (9, one[:-5])])))
    with pytest.raises(ValueError):
        list(parse_arc(iter([(0, one)])))


def test_declared_lengths_delimit_records():
    """Records across chunk borders anywhere, several in a chunk; bytes left over raise."""
    from carestrata.llm.arc import arc_head, arc_record, members, packed, parse_arc

    pick = random.Random(6)
    for version in (1, 2):
        contents = [bytes(pick.choices(b"ab \n\r1", k=pick.randint(0, 40))) for _ in range(30)]
        whole = arc_head(version, "x.arc") + b"".join(arc_record(version, "x.arc", 0, f"http://h/{i}", c) for i, c in enumerate(contents))
        for parts in (1, 2, 7, 40):
            cuts = [0, *sorted(pick.sample(range(len(whole)), parts - 1)), len(whole)]
            chunks = [whole[a:b] for a, b in zip(cuts, cuts[1:])]
            for data in (iter([(0, c) for c in chunks]), members(b"".join(map(packed, chunks)))):
                found = list(parse_arc(data))
                assert [c for _, _, c in found] == contents and [f["URL"] for _, f, _ in found] == [f"http://h/{i}" for i in range(30)]
                assert all(whole[offset:].startswith(b"http://h/") for offset, _, _ in found)
        assert [c for _, _, c in parse_arc(members(whole))] == contents  # a file that is not packed
        for broken in (whole + b"x", whole[:-2], whole + arc_record(version, "x", 0, "u", b"abc")[:-3], whole[:-1] + b"?" + whole):
            with pytest.raises(ValueError):
                list(parse_arc(iter([(0, broken)])))


def test_archives_of_other_tools(spark, tmp_path):
    from carestrata.llm.arc import arc_head, arc_record, archive_digests, convert_archives, packed, read_warc

    pages = {n: f"page {n} ".encode() * (200 if n < 3 else 1) for n in range(6)}
    body = lambda n: b"HTTP/1.1 200 OK\r\nX-Page-Id: %d\r\n\r\n" % n + pages[n]
    for version, name in ((1, "one.arc.gz"), (2, "two.arc")):
        own = range(3) if version == 1 else range(3, 6)
        data = arc_head(version, name) + b"".join(arc_record(version, name, 0, "http://u/", body(n)) for n in own)
        (tmp_path / name).write_bytes(packed(data) if name.endswith("gz") else data)
    out = archive_digests(read_warc(spark, convert_archives(spark, f"file://{tmp_path}"))).collect()
    assert {r["page_id"]: r["payload_digest"] for r in out} == {n: hashlib.sha1(p).hexdigest() for n, p in pages.items()}


def test_archive_ties(spark):
    from carestrata.llm.arc import archive_digests, convert_archives, read_warc, write_arc

    big, small = "b" * 1000, "s" * 999
    rows = [(1, "u", big), (7, None, big), (7, "u u", big), (None, "u", big), (2, "u", small), (3, "u", small), (4, "u", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = archive_digests(read_warc(spark, convert_archives(spark, write_arc(pages)))).collect()
    assert sorted(r["record_type"] for r in out if r["payload_bytes"] == 1000) == ["response", "revisit", "revisit", "revisit"]
    assert {r["refers_to"] for r in out if r["record_type"] == "revisit"} == {7}
    assert all(r["record_type"] == "response" and r["refers_to"] is None for r in out if r["payload_bytes"] < 1000)


def test_toxicity_learns_subwords():
    from carestrata.llm.toxicity import train

    pick = random.Random(8)
    clean = "river stone garden window letter morning paper bridge summer silver".split()
    bad = ["blarghface", "blarghhead", "snorkdust", "snorkmire"]
    text = lambda toxic: " ".join(pick.choices(clean, k=60) + (pick.choices(bad, k=2) if toxic else []) + pick.choices(clean, k=60))
    labels = [i % 2 for i in range(120)]
    model = train([text(y) for y in labels], labels, 0.5)
    unseen = [" ".join(clean * 9 + [w] + clean * 9) for w in ("blarghfase", "snorkdusst")]
    assert min(model.documents(unseen, {})) > 10 * max(model.documents([text(0) for _ in range(20)], {}))
    assert model.documents([None, ""], {}) == [0.5, 0.5]


def test_toxicity_held_out(spark):
    from carestrata.llm.common import table
    from carestrata.llm.toxicity import score_documents

    sf_dir = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, sf_dir, "labels").collect()}
    found = score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).collect()
    held = [r for r in found if r["held_out"] and r["doc_id"] in labels]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in found)
    hits = [r["predicted"] for r in held if labels[r["doc_id"]] == 1]
    false = [r["predicted"] for r in held if labels[r["doc_id"]] == 0]
    assert np.mean(hits) >= 0.4 and np.mean(false) <= 0.02  # about thirty toxic documents to learn from


def test_leaks_with_substitutions(spark):
    from carestrata.llm.decontam import contamination

    item = [f"k{i}" for i in range(30)]

    def with_changes(*at):
        return " ".join(["pre", "fix"] + ["no" if i in at else w.upper() for i, w in enumerate(item)] + ["end"])

    rows = [
        (1, with_changes()), (2, with_changes(*range(0, 30, 6))), (3, with_changes(*range(0, 30, 4))), (4, " ".join(item[:12])),
        (5, "x " + " ".join(item[:13])), (6, "s1 s2 s3 s4 s5 s6"), (7, "s1 s2 s3 s4 s5 no"), (8, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(11, " ".join(item)), (12, "z s1".split()[0] + " s"), (13, "s1 s2 s3 s4 s5 s6")], "item_id long, text string")
    found = {r["doc_id"]: (r["contaminated"], r["item_id"]) for r in contamination(docs, bench).collect()}
    want = {}
    for i, text in rows:
        words = (text or "").lower().split()
        hit = any(sum(a == b for a, b in zip(words[p : p + 13], item[q : q + 13])) >= 11 for p in range(len(words) - 12) for q in range(18))
        want[i] = (True, 11) if hit else (i == 6, 13 if i == 6 else None)
    assert found == want and want[2][0] and not want[3][0] and not want[4][0]


def test_mixing_follows_the_distribution(spark):
    from carestrata.llm.mixing import mixing_rates, poisson_mix

    docs = spark.range(20_000).selectExpr("id AS doc_id", "if(id < 16000, 'a', if(id < 19990, 'b', 'c')) AS source", "'t' AS text")
    rates = {r["source"]: r["rate"] for r in mixing_rates(docs, {"a": 1.0, "b": 2.0, "c": 1.0}).collect()}
    assert rates == pytest.approx({"a": 5000 / 16000, "b": 10000 / 3990, "c": 500.0})
    out = poisson_mix(docs, {"a": 1.0, "b": 2.0, "c": 1.0})
    counts = {(r["source"]): r["count"] for r in out.groupBy("source").count().collect()}
    for name, mean in (("a", 5000), ("b", 10000), ("c", 5000)):
        assert abs(counts[name] - mean) < 5 * mean**0.5
    per_doc = collections.Counter(r["doc_id"] for r in out.where("source = 'b'").select("doc_id").collect())
    share = sum(v == 2 for v in per_doc.values()) / 3990
    lam = rates["b"]
    assert share == pytest.approx(np.exp(-lam) * lam**2 / 2, abs=0.03)
    keys = [r["shuffle_key"] for r in out.select("shuffle_key").collect()]
    assert keys == sorted(keys)


def test_shuffled_read_is_a_permutation(spark, sf_dir):
    from carestrata.llm.common import table
    from carestrata.llm.records import read_records, read_shuffled, write_records

    docs = table(spark, sf_dir, "documents")
    folder = write_records(docs.union(docs.limit(3)).union(docs.selectExpr("NULL AS doc_id", "text", "lang", "source", "n_chars").limit(2)), tokenizer_path(), shard_bytes=60_000)
    told = lambda df: [(r["doc_id"], tuple(r["ids"])) for r in df.select("doc_id", "ids").collect()]
    in_order, one, same, other = told(read_records(spark, folder)), *(told(read_shuffled(spark, folder, seed)) for seed in (1, 1, 2))
    assert sorted(one, key=repr) == sorted(other, key=repr) == sorted(in_order, key=repr) and len(one) == docs.count() + 5
    assert one == same and one != other and one != in_order
    places = [r["place"] for r in read_shuffled(spark, folder, 1).select("place").collect()]
    assert places == sorted(places)


def test_pipeline(spark, sf_dir, documents):
    import corpus_pipeline
    from carestrata.llm.decontam import contamination
    from carestrata.llm.simhash import simhash_components
    from carestrata.llm.toxicity import score_documents

    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    docs, kept = read("documents"), {}
    columns = docs.columns
    for name, step in corpus_pipeline.STAGES[:3]:
        after = corpus_pipeline.stage(step(spark, docs, sf_dir), "test").select("*")
        assert after.columns == columns
        if name == "toxicity":
            want = {r["doc_id"] for r in score_documents(docs, read("labels")).collect() if not r["predicted"]}
        elif name == "simhash_near_dedup":
            want = {r["component_id"] for r in simhash_components(docs).collect()}
        else:
            want = {r["doc_id"] for r in contamination(docs, read("benchmark")).collect() if not r["contaminated"]}
        kept[name] = {r["doc_id"] for r in after.select("doc_id").collect()}
        assert kept[name] == want
        docs = after
    mixed = corpus_pipeline.mix_sources(spark, docs, sf_dir)
    assert mixed.columns == columns
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert collections.Counter(r["doc_id"] for r in rows) == collections.Counter(r["doc_id"] for r in mixed.collect())
