"""Dedup operators against brute force."""

from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
import xxhash

from salesflow.llm import components, embed_dedup, exact_dedup, line_dedup, simhash
from salesflow.llm.queries import QUERIES
from salesflow.session import unique_table

SF = "/root/testdata/sf0.001"


def union(nodes, pairs):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def plain_fingerprint(text):
    words = lower(text or "").encode().split()
    sh = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    count = [0] * 64
    for s in sh:
        h = xxhash.xxh64_intdigest(s, seed=42)
        for b in range(64):
            count[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * count[b] > len(sh))


def test_components(spark):
    rng = np.random.default_rng(5)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(300, i) for i in range(301, 420)]
    pairs += [tuple(x) for x in rng.integers(1000, 1200, (110, 2)).tolist()] + [(7, 7), (5, None), (None, None)]
    got = {r["node"]: r["component"] for r in components.connected_components(
        spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    real = [(a, b) for a, b in pairs if a is not None and b is not None and a != b]
    assert got == union({x for p in real for x in p}, real)
    assert components.connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_fingerprint_law(odd):
    for r in odd.collect():
        assert simhash.fingerprint(r["text"]) == plain_fingerprint(r["text"])
    long = " ".join(str(i) for i in range(70000))
    assert simhash.fingerprint(long) == plain_fingerprint(long)


def brute_groups(rows):
    fp = {i: plain_fingerprint(t) for i, t in rows}
    ids = sorted(fp)
    pairs = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1:] if (fp[a] ^ fp[b]).bit_count() <= 4]
    return {i: (f"{fp[i]:016x}", c) for i, c in union(ids, pairs).items()}


def test_op10_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op10_simhash"](spark, SF).collect()}
    assert got == brute_groups([tuple(r) for r in rows])


@pytest.mark.parametrize("at_once", [2_000_000, 3000])
def test_links_find_every_near_pair(spark, monkeypatch, at_once):
    """Random and clustered fingerprints, with the expansion cut or not."""
    rng = np.random.default_rng(9)
    fp = rng.integers(0, 1 << 63, 60, np.uint64).tolist()
    for f in fp[:25]:
        for _ in range(6):
            for b in rng.choice(64, rng.integers(1, 7), replace=False).tolist():
                f ^= 1 << b
            fp.append(f)
    fp = sorted(set(fp))
    monkeypatch.setattr(simhash, "VARIANTS_AT_ONCE", at_once)
    left = np.full(len(fp), 2)
    if at_once < 10_000:  # the function itself: executors import their own module
        links = []
        simhash._meet(np.array(fp, np.uint64), left, 64, links)
        pairs = [(fp[a], fp[b]) for x, y in links for a, b in zip(x.tolist(), y.tolist())]
    else:
        signed = np.array(fp, np.uint64).view(np.int64).tolist()
        pairs = [tuple(np.array([r["a"], r["b"]], np.int64).view(np.uint64).tolist()) for r in simhash.link_fingerprints(
            spark.createDataFrame([(x,) for x in signed], "fp bigint")).collect()]
    want = [(a, b) for n, a in enumerate(fp) for b in fp[n + 1:] if (a ^ b).bit_count() <= 4]
    if at_once < 10_000:
        assert all((a ^ b).bit_count() <= 4 for a, b in pairs)
    assert union(fp, pairs) == union(fp, want)


def test_hot_keys_are_split_and_lose_no_link(spark, monkeypatch):
    """Near copies that share their leading bits: keys split until small."""
    rng = np.random.default_rng(4)
    base = int(rng.integers(0, 1 << 63, dtype=np.uint64))
    fp = {base}
    for _ in range(140):
        f = base
        for b in rng.choice(64, rng.integers(1, 9), replace=False).tolist():
            f ^= 1 << b
        fp.add(f)
    fp = sorted(fp | set(rng.integers(0, 1 << 63, 20, np.uint64).tolist()))
    monkeypatch.setattr(simhash, "HOT_ROWS", 100)
    split, seen = simhash._deepen, []
    monkeypatch.setattr(simhash, "_deepen", lambda *a: (seen.append(a[1]), split(*a))[1])
    signed = np.array(fp, np.uint64).view(np.int64).tolist()
    links = simhash.link_fingerprints(spark.createDataFrame([(x,) for x in signed], "fp bigint")).collect()
    pairs = [tuple(np.array([r["a"], r["b"]], np.int64).view(np.uint64).tolist()) for r in links]
    want = [(a, b) for n, a in enumerate(fp) for b in fp[n + 1:] if (a ^ b).bit_count() <= 4]
    assert seen[:2] == [0, 8]
    assert union(fp, pairs) == union(fp, want)  # a forest: its ends need not be near


def test_odd_max_bits_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.link_fingerprints(spark.createDataFrame([(1,)], "fp bigint"), 3)


def test_simhash_odd_rows(odd, none):
    rows = simhash.simhash_groups(odd).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows}
    assert {by[i]["component_id"] for i in (0, 1, 2, 3)} == {0}
    assert by[1]["fingerprint"] == "0" * 16
    assert {by[i]["component_id"] for i in (6, 7, 8)} == {6}
    assert simhash.simhash_groups(none).count() == 0


def test_op6_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    same = defaultdict(list)
    for i, t in rows:
        same[sha256(lower(t or "").encode()).hexdigest()].append(i)
    want = {i: (max(ids), len(ids), i == max(ids), h) for h, ids in same.items() for i in ids}
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op6_exact_dedup"](spark, SF).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()}
    assert got == want


def test_digest_index_over_loads(spark, odd, none):
    index = exact_dedup.DigestIndex(spark, unique_table("t_digests"), 4)
    first = index.load(spark.createDataFrame([(1, "one"), (2, "ONE"), (3, "two"), (9, None)], "doc_id bigint, text string"))
    assert {tuple(r)[:4] for r in first.collect()} == {(1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True), (9, 9, 1, True)}
    again = exact_dedup.DigestIndex(spark, index.table)  # another run opens the same table
    second = again.load(spark.createDataFrame([(7, "One"), (8, "three"), (10, "")], "doc_id bigint, text string"))
    assert {tuple(r)[:4] for r in second.collect()} == {(7, 2, 1, False), (8, 8, 1, True), (10, 9, 1, False)}
    assert {tuple(r)[:4] for r in again.load(spark.createDataFrame([(3, "two")], "doc_id bigint, text string")).collect()} == {(3, 3, 1, True)}
    assert index.known().count() == index.known().select("digest").distinct().count() == 4
    assert again.load(none).count() == 0
    rows = exact_dedup.DigestIndex(spark, unique_table("t_digests"), 2).load(odd).collect()
    assert len(rows) == odd.count()
    assert {r["keep_id"] for r in rows if r["doc_id"] in (6, 7, 8)} == {8}


def test_index_join_is_a_merge_without_shuffle_of_the_index(spark):
    index = exact_dedup.DigestIndex(spark, unique_table("t_digests"), 4)
    index.load(spark.createDataFrame([(1, "one")], "doc_id bigint, text string"))
    new = spark.createDataFrame([(b"x" * 32,)], "digest binary").repartition(4, "digest")
    plan = new.join(index.known().hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 1 and "Bucketed: true" in plan


def brute_embeddings(rows, t):
    ok = {}
    for i, label, v in rows:
        if label is not None and v is not None and None not in v and len(v) and np.isfinite(v).all() and np.any(v):
            ok.setdefault((label, len(v)), []).append((i, np.array(v, float)))
    links, pairs = {i: 0 for i, *_ in rows}, []
    for group in ok.values():
        ids = [i for i, _ in group]
        x = np.stack([v / np.abs(v).max() for _, v in group])
        n = np.sqrt((x * x).sum(1))
        s = (x @ x.T) / (n[:, None] * n[None])
        for a, b in zip(*np.nonzero(np.triu(s >= t, 1))):
            links[ids[a]] += 1
            links[ids[b]] += 1
            pairs.append((ids[a], ids[b]))
    comp = union(links, pairs)
    return {i: (links[i], comp[i], comp[i] == i) for i in links}


def planted(n, labels, seed=0, dim=16):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for i in range(0, n, 4):  # chains of near copies around the threshold
        x[i + 1] = x[i] + rng.normal(size=dim) * rng.uniform(0, 0.5)
        x[i + 2] = x[i + 1] + rng.normal(size=dim) * rng.uniform(0, 0.4)
    x[n // 2: n // 2 + n // 4] = x[5]
    return [(int(i), int(i) // 4 % labels if i < n // 2 else 0, v.tolist()) for i, v in enumerate(x)]


EMBED = "vec_id bigint, label int, embedding array<double>"


def test_op3_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    got = {r["vec_id"]: tuple(r)[1:] for r in QUERIES["op3_embedding_dedup"](spark, SF).collect()}
    assert got == brute_embeddings(rows, 0.93)


def test_cells_and_blocks_lose_no_pair(spark, monkeypatch):
    rows = planted(1200, 2)
    monkeypatch.setattr(embed_dedup, "CELL_ROWS", 60)
    monkeypatch.setattr(embed_dedup, "BLOCK_ROWS", 50)
    got = {r["vec_id"]: tuple(r)[1:] for r in embed_dedup.embedding_groups(spark.createDataFrame(rows, EMBED)).collect()}
    want = brute_embeddings(rows, 0.93)
    assert got == want and sum(n for n, *_ in want.values()) > 1000


def test_embeddings_odd_rows(spark):
    rows = [(1, 0, [1.0, 0.0]), (2, 0, [2.0, 0.0]), (3, None, [1.0, 0.0]), (4, 0, None), (5, 0, [0.0, 0.0]), (6, 0, []),
            (7, 0, [float("nan"), 1.0]), (8, 0, [float("inf"), 1.0]), (9, 1, [1.0, 0.0]), (10, 0, [1e300, 1.0]), (11, 0, [1.0, 0.0, 0.0]),
            (12, 0, [1.0, None])]
    got = {r["vec_id"]: tuple(r)[1:] for r in embed_dedup.embedding_groups(spark.createDataFrame(rows, EMBED)).collect()}
    assert {i: got[i] for i in (1, 2, 10)} == {1: (2, 1, True), 2: (2, 1, False), 10: (2, 1, False)}
    assert all(got[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 11, 12))
    assert embed_dedup.embedding_groups(spark.createDataFrame([], EMBED)).count() == 0
    clash = spark.createDataFrame([(1, 0, [1.0], 5, 6), (1, 0, [1.0], 5, 6)], EMBED + ", n_links int, component_id int")
    assert [tuple(r) for r in embed_dedup.embedding_groups(clash).collect()] == [(1, 1, 1, True)] * 2


def plain_lines(rows, min_docs=2):
    """The template tree over plain dictionaries."""
    held, kinds = defaultdict(set), defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            for k, fill in line_dedup.template_keys(line):
                held[k].add(i)
                kinds[k].add(fill)

    def recurs(k, fill):
        return len(held[k]) >= min_docs if fill < 0 else len(held[k]) >= 3 and len(kinds[k]) >= 3
    gone = defaultdict(list)
    for i, t in rows:
        for n, line in enumerate((t or "").split("\n")):
            if any(recurs(k, fill) and min(held[k]) != i for k, fill in line_dedup.template_keys(line)):
                gone[i].append(n)
    return gone


def test_text_that_occurs_once_stays(spark):
    """Two long sentences that share their beginning alone, two short ones of
    two fillings: nothing is a field, nothing goes."""
    head = "The council said on Monday that a new bridge over the river will "
    rows = [(1, head + "be built next year by the city"), (2, head + "never be paid for by anyone here"),
            (3, head + "open to all on the first day"), (4, "At the gate user anna logged in today"), (5, "At the gate user otto logged in today")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r["doc_id"]: r["text"] for r in line_dedup.drop_recurring_lines(df).collect()} == dict(rows)
    more = [*rows, (6, "At the gate user mary logged in today"), (7, head + "be built next year by the city")]
    got = {r["doc_id"]: r["text"] for r in line_dedup.drop_recurring_lines(spark.createDataFrame(more, "doc_id bigint, text string")).collect()}
    assert [i for i, t in got.items() if not t] and {i for i, t in got.items() if not t} == {5, 6, 7}  # a third filling, an equal line


def test_columns_of_any_name_are_kept(spark):
    rows = [(1, "one line that recurs in both", "a", "b", "c"), (2, "one line that recurs in both", "d", "e", "f")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, _id string, _h string, _row string")
    got = sorted(tuple(r) for r in line_dedup.drop_recurring_lines(df).collect())
    assert got == [(*rows[0], []), (2, "", "d", "e", "f", [0])]


def test_op8_equals_plain_dictionaries(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = plain_lines(rows)
    got = QUERIES["op8_line_dedup"](spark, SF).collect()
    assert {r["doc_id"]: r["dropped_lines"] for r in got} == {i: want.get(i, []) for i, _ in rows}
    texts = dict(rows)
    for r in got:
        keep = [x for n, x in enumerate(texts[r["doc_id"]].split("\n")) if n not in set(r["dropped_lines"])]
        assert r["text"] == "\n".join(keep) and r["n_dropped"] == len(r["dropped_lines"])
    assert any(want.values())


def test_templates_generalise_and_keep_clean_lines(spark):
    body = "At the gate user {} logged in from host {} and left again"
    rows = [(1, body.format("anna", "web1") + "\nAn own line that no other document has"), (2, body.format("anna", "db22")),
            (3, body.format("otto", "db22")), (12, body.format("mary", "web1")), (4, "At the gate user manuals are kept in the office today and are used"),
            (5, "12 13 14 15 16 17"), (6, "22 23 24 25 26 27"), (7, "short line"), (8, "short line"), (9, None), (10, ""),
            (None, body.format("anna", "web1"))]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, dropped_lines string")
    got = {r["doc_id"]: (r["text"], r["dropped_lines"]) for r in line_dedup.drop_recurring_lines(df).collect()}
    assert got[2] == ("", [0]) and got[3][0] == "" and got[12][0] == ""
    for i, t in rows:
        if i not in (2, 3, 12):
            assert got[i] == (t, [])


def test_short_lines_and_lines_without_spaces_drop(spark):
    long = "本サイトに掲載されている記事や写真の無断転載を禁じます。" * 9
    thai = "สงวนลิขสิทธิ์ตามกฎหมายห้ามทำซ้ำ"
    rows = [(1, f"All rights reserved.\n\n{long}あ\nPage 1"), (2, f"All  rights reserved.\n\n{long}い\nPage 2"),
            (3, f"All rights reserved.\n\n{thai}\n明日は雨です"), (4, f"Les.\n\n{thai}\n明日は雪です"), (5, "Les.\n \nAll rights, reserved.")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {s: {r["doc_id"]: r["dropped_lines"] for r in line_dedup.drop_recurring_lines(df, short_docs=s).collect()} for s in (2, 3)}
    # the long lines differ in their last character: only two documents hold the rest, so both stay
    assert got[2] == {1: [], 2: [0], 3: [0], 4: [2], 5: [0]}
    assert got[3] == {1: [], 2: [0], 3: [0], 4: [2], 5: []}


def test_op8_drops_every_recurring_short_line(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if 0 < len(line.split()) < 5:
                held[" ".join(line.split())].add(i)
    left = defaultdict(set)
    for r in QUERIES["op8_line_dedup"](spark, SF).collect():
        for line in (r["text"] or "").split("\n"):
            left[" ".join(line.split())].add(r["doc_id"])
    assert any(len(v) > 1 for v in held.values()) and all(left[k] == {min(v)} for k, v in held.items())


def test_line_odd_rows(odd, none):
    out = line_dedup.drop_recurring_lines(odd)
    assert out.count() == odd.count() and sorted(out.columns) == sorted(odd.columns)
    got = {r["doc_id"]: r["text"] for r in out.collect() if r["doc_id"] is not None}
    assert got[0] is None and got[1] == "" and got[6] and got[8] == "" and got[9].startswith("word")
    assert line_dedup.drop_recurring_lines(none).count() == 0
