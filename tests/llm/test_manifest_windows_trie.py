"""Operators 11 to 13 against brute force, on edge rows and on small blocks."""

import hashlib
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from trustgrid.llm import prefix_trie, superkmer_dedup
from trustgrid.llm.merkle_manifest import fold, merkle_witnesses, op11_merkle_manifest
from trustgrid.llm.prefix_trie import joined_digest, op13_prefix_trie
from trustgrid.llm.superkmer_dedup import dedup_windows, op12_superkmer_dedup

DOCS = "doc_id long, text string, lang string, source string, n_chars long, grp string, pos string, digest string, id int"


def sha(s) -> str:
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def edge_docs(n=90):
    """Nulls in every column, empty texts, repeated rows and ids, a hot source, a single-document source."""
    rows = []
    for i in range(n):
        source = None if i % 17 == 3 else "lonely" if i == 40 else "hot" if i % 3 else f"s{i % 4}é"
        text = None if i % 19 == 5 else "" if i % 23 == 7 else f"Text Nr {i} ÄÖ\n" + "Word " * (i % 30)
        rows.append((i, text, None if i % 7 == 0 else "de", source, None if i % 11 == 0 else len(text or ""), "x", "y", "z", 1))
    rows += [rows[4], rows[4], (8, "another text of id 8", "en", "hot", 5, "x", "y", "z", 1), (None, "no id", "en", "hot", 5, "", "", "", 2)]
    return rows


# --- op11 -----------------------------------------------------------------------------------

def plain_tree(level):
    """(root, proof per leaf) of a list of digests."""
    proofs, own = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for j, i in enumerate(own):
            a = i // 16 * 16
            proofs[j] += [x for k, x in enumerate(level[a:a + 16], a) if k != i]
            own[j] = i // 16
        level = [sha("".join(level[a:a + 16])) for a in range(0, len(level), 16)]
    return level[0], proofs


def plain_manifest(rows):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    by = defaultdict(list)
    for doc_id, text, lang, source, n_chars, *_ in rows:
        leaf = sha("".join(map(field, (doc_id, source, lang, n_chars, text))))
        by[source].append(((doc_id is not None, doc_id or 0), leaf))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([leaf for _, leaf in sorted(by[s])]) for s in sources}
    root, upper = plain_tree([trees[s][0] for s in sources])
    out = []
    for s, above in zip(sources, upper):
        for (key, leaf), proof in zip(sorted(by[s]), trees[s][1]):
            out.append((key[1] if key[0] else None, leaf, trees[s][0], root, sha("".join(proof + above))))
    return out


@pytest.mark.parametrize("height", [1, 3])
def test_manifest_equals_plain_trees(spark, height):
    rows = edge_docs()
    got = op11_merkle_manifest(spark.createDataFrame(rows, DOCS).repartition(3), height).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r[:5]) for r in got), key=key) == sorted(plain_manifest(rows), key=key)
    text = {r[0]: r[1] for r in rows if r[0] not in (4, 8)}
    for r in got:
        hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        if r["doc_id"] in text:
            changed = hit and text[r["doc_id"]] is not None and re.search("[A-Z]", text[r["doc_id"]]) is not None
            assert r["verified"] == (not changed) == (r["folded_root"] == r["root"])


def test_manifest_of_nothing_and_of_one(spark):
    assert op11_merkle_manifest(spark.createDataFrame([], DOCS)).collect() == []
    one = op11_merkle_manifest(spark.createDataFrame(edge_docs()[:1], DOCS)).first()
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"]
    assert one["proof_sha256"] == sha("") and one["verified"]


def test_witnesses_of_several_rounds(spark):
    """Height 1 over 600 leaves: three rounds; every witness leads to the root, a wrong leaf does not."""
    leaves = spark.range(600).select(F.lit("g").alias("own_group"), "id", F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("digest"))
    out = merkle_witnesses(leaves, ["id"], "own_group", height=1)
    assert out.columns[:3] == ["own_group", "id", "digest"]
    rows = out.select("*", fold(F.col("digest"), F.col("witness"), F.col("steps")).alias("folded"),
                      fold(F.col("root"), F.col("witness"), F.col("steps")).alias("wrong")).collect()
    root, proofs = plain_tree([sha(str(i)) for i in range(600)])
    for r in rows:
        assert r["folded"] == r["root"] == root != r["wrong"]
        assert r["witness"].hex() == "".join(proofs[r["id"]])


# --- op12 -----------------------------------------------------------------------------------

def plain_windows(rows, size):
    docs = {}
    for doc_id, text, *_ in rows:
        docs[(doc_id is not None, doc_id or 0, text or "")] = re.findall("[^\x20\x09-\x0d]+", text or "")
    first = {}
    for key in sorted(docs, key=lambda k: k[:2]):
        for i in range(len(docs[key]) - size + 1):
            first.setdefault(tuple(docs[key][i:i + size]), (key, i))
    out = {}
    for key, ws in docs.items():
        gone = set()
        for i in range(len(ws) - size + 1):
            if first[tuple(ws[i:i + size])] != (key, i):
                gone.update(range(i, i + size))
        out[key] = (len(ws), len(gone), sha(" ".join(w for j, w in enumerate(ws) if j not in gone)))
    return out


def passages(n=160, seed=5):
    import random
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "der", "été", "x1", "the", "of", "Łódź"]) + str(rng.randint(0, 60))
    shared = [" ".join(word() for _ in range(rng.randint(18, 70))) for _ in range(6)]
    phrase = " ".join(word() for _ in range(9))              # shorter than a window, in a third of all texts
    rows = []
    for i in range(n):
        parts = [" ".join(word() for _ in range(rng.randint(0, 60))) for _ in range(3)]
        if i % 3 == 0:
            parts.insert(1, phrase)
        if i % 4 == 0:
            parts.insert(2, rng.choice(shared))
        if i % 10 == 0:
            parts.append("loop " * rng.randint(5, 90) + "one two three " * rng.randint(1, 30))
        text = rng.choice([" ", "\n", "\t  ", "\r\n"]).join(parts)
        rows.append((i, text, None, None, None, "x", "y", "z", 1))
    rows += [(n, rows[8][1], *rows[8][2:]), rows[12], (None, rows[16][1], *rows[16][2:]), (n + 1, None, *rows[8][2:]),
             (n + 2, "", *rows[8][2:]), (n + 3, " \n ", *rows[8][2:]), (n + 4, "w " * 3000, *rows[8][2:])]
    rng.shuffle(rows)
    return rows


def check_windows(spark, rows, got):
    want = plain_windows(rows, superkmer_dedup.WORDS)
    text = defaultdict(list)
    for doc_id, t, *_ in rows:
        text[doc_id].append(t or "")
    for r in got:
        options = [want[(r["doc_id"] is not None, r["doc_id"] or 0, t)] for t in text[r["doc_id"]]]
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) in options
    assert len(got) == len(rows)


def test_windows_equal_brute_force(spark):
    rows = passages()
    check_windows(spark, rows, op12_superkmer_dedup(spark.createDataFrame(rows, DOCS).repartition(5)).collect())


def test_windows_with_frequent_minimisers(spark, monkeypatch):
    """With a bound of one sampled string every minimiser counts as frequent at once, and results stay."""
    monkeypatch.setattr(superkmer_dedup, "LEAST_FREQUENT", 2)
    monkeypatch.setattr(superkmer_dedup, "SAMPLE", 1)
    rows = passages(seed=6)
    check_windows(spark, rows, op12_superkmer_dedup(spark.createDataFrame(rows, DOCS).repartition(5)).collect())


def test_windows_of_other_sizes_and_spans(spark):
    df = spark.createDataFrame([("a", "p q r s t"), ("b", "q r s z q r s"), ("c", None)], "name string, body string")
    out = {r["name"]: r for r in dedup_windows(df, "name", "body", size=3, gram=2).collect()}
    assert (out["a"]["kept"], out["a"]["removed"]) == ("p q r s t", [])
    assert out["b"]["kept"] == "z" and [tuple(s) for s in out["b"]["removed"]] == [(0, 3), (4, 7)]
    assert out["c"]["n_words"] == 0 and out["c"]["kept"] == ""
    assert op12_superkmer_dedup(spark.createDataFrame([], DOCS)).collect() == []
    with pytest.raises(ValueError):
        dedup_windows(df, "name", "body", size=3, gram=4)


# --- op13 -----------------------------------------------------------------------------------

CONV = "conv_id long, turn long, role string, text string, conv string, pos long, n int"


def conversations(n=230):
    import random
    rng = random.Random(9)
    rows = []
    for c in range(n):
        if c in (100, 7):
            continue
        size = 70 if c == 33 else rng.choice([1, 2, 3, 4, 5, 8, 9, 13])
        same = c % 3 == 0
        for t in range(size):
            text = f"shared {t}" if same and t < size - c % 2 else rng.choice([None, "", f"éß {c % 5}", f"t{t}"])
            rows.append((c, None if t == 0 and c % 9 == 4 else t, rng.choice(["user", None]) if not same else "user", text, "x", 1, 1))
    rows += [(None, 0, "user", "nobody's turn", "x", 1, 1), rows[5], (7, 0, "user", "only one", "x", 1, 1), (207, 0, "u", "z", "x", 1, 1)]
    rng.shuffle(rows)
    return rows


def plain_trie(rows, digest):
    by = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            by[c].append(((t is not None, t or 0), digest(role, text), role, text))
    own = {c: [x[2:] for x in sorted(v)] for c, v in by.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(own.get(c - c % 100, [])[:h]) + tuple(own[c][h:])
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)

    def below(p):
        parts = [below(k) for k in kids[p]]
        return (sum(a for a, _ in parts) or int(not kids[p]),
                sum(b for _, b in parts) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0))

    out = []
    for p, who in members.items():
        leaves, saved = below(p)
        ends = sorted(c for c in who if whole[c] == p)
        out.append((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), len(kids[p]), leaves, saved,
                    sha(",".join(map(str, ends)))))
    return out


def turn_digest(role, text):
    return sha(f"{len(role.encode())}:{role}{text}")


@pytest.mark.parametrize("block, segment, ends", [(4, 4096, 1 << 16), (3, 2, 2), (1, 3, 5)])
def test_trie_equals_plain_prefixes(spark, monkeypatch, block, segment, ends):
    for name, value in (("BLOCK", block), ("SEGMENT", segment), ("ENDS", ends)):
        monkeypatch.setattr(prefix_trie, name, value)
    rows = conversations()
    got = [tuple(r) for r in op13_prefix_trie(spark.createDataFrame(rows, CONV).repartition(4)).collect()]
    key = lambda r: (r[1], r[0])
    assert sorted(got, key=key) == sorted(plain_trie(rows, turn_digest), key=key)


def test_trie_of_nothing_and_of_one(spark):
    assert op13_prefix_trie(spark.createDataFrame([], CONV)).collect() == []
    one = op13_prefix_trie(spark.createDataFrame([(5, 0, "user", "hi", "x", 1, 1)], CONV)).collect()
    assert sorted(tuple(r) for r in one) == sorted(plain_trie([(5, 0, "user", "hi")], turn_digest))


def test_ends_are_hashed_piece_by_piece(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "ENDS", 7)
    ends = spark.range(100).select(F.col("id").alias("conv"), (F.col("id") % 2).alias("depth"), F.lit(0).cast("long").alias("i1"),
                                   F.lit(3).cast("long").alias("i2"))
    got = {r["depth"]: r["ends_sha256"] for r in joined_digest(ends).collect()}
    assert got == {k: sha(",".join(str(i) for i in range(100) if i % 2 == k)) for k in (0, 1)}
