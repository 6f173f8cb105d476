"""Every corpus operator on small tables with nulls, empty and long texts, ties, repeated rows, extra columns."""

import hashlib
import random

import numpy as np
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, node long, hash long"


def table(spark, texts, langs=None, sources=None):
    rows = [(i, t, (langs or {}).get(i), (sources or {}).get(i), None, 0.5, 1, 2) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def words(seed, n, vocab=400):
    r = random.Random(seed)
    return " ".join("".join(r.choices("abcdefghij", k=r.randint(2, 7))) for _ in range(n))


EDGE = [None, "", " ", "x", "Ünï ß ſ", "\n\n", words(1, 30), words(1, 30), words(2, 4000)]


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, []).limit(0)


# --- secrets ---------------------------------------------------------------------------

def test_secret_scan_matches_plain_patterns(spark):
    import re
    from trustgrid.llm.secret_scan import op6_secret_scan
    texts = EDGE + [
        'password = "abc123x" and TOKEN:short; token: secret = abcdefgh', "AKIA" + "A1" * 9 + " AKIAABC " + "0af" * 9,
        "ſecret=abcdefgh api_key='zzzzzzzz' apikey=ab", "see https://a.example/x\nuser=alice Ab3" + "xY9" * 8,
        "Ab3" + "xY9" * 8, "user=alice\n\n" + "far " * 5 + "Ab3" + "xY9" * 8]
    got = {r.doc_id: r for r in op6_secret_scan(table(spark, texts)).collect()}
    pats = {"assign": re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
                                 r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
            "access": re.compile("AKIA[A-Z0-9]+"), "hex": re.compile("[0-9a-f]+")}
    for i, t in enumerate(texts):
        spans = []
        for k, p in pats.items():
            for m in p.finditer(t or ""):
                least = {"assign": 6, "access": 20, "hex": 24}[k]
                if len(m.group(2) if k == "assign" else m.group()) >= least:
                    spans.append((m.start(), list(pats).index(k), k, m.end()))
        text = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans))
        assert got[i].base_sha256 == hashlib.sha256(text.encode()).hexdigest(), t
        assert got[i].n_hex == sum(s[2] == "hex" for s in spans)
    n = len(EDGE)
    assert got[n + 3].n_linked == 3 and got[n + 4].n_linked == 0 and got[n + 5].n_linked == 0


# --- fingerprints ------------------------------------------------------------------------

def test_fingerprints(spark):
    from trustgrid.llm.lz_fingerprint import op5_lz_fingerprint
    rows = {r.doc_id: r for r in op5_lz_fingerprint(table(spark, EDGE)).collect()}
    assert len(rows) == len(EDGE)
    texts = [t or "" for t in EDGE]
    for i, t in enumerate(texts):
        nxt, q = texts[(i + 1) % len(texts)], len(t) // 4
        assert rows[i].n_chars == len(t)
        assert rows[i].edited_sha256 == hashlib.sha256((t[:len(t) - q] + nxt[:q]).encode()).hexdigest()
    assert rows[6].fingerprint == rows[7].fingerprint and rows[6].near_next == 1.0
    assert rows[0].near_edited == 1.0 and rows[1].near_next == 0.0
    assert rows[8].near_edited > 0.5 > rows[7].near_next


# --- suffix dedup --------------------------------------------------------------------------

def removed(raws, n):
    from collections import Counter
    seen = Counter(r[i:i + n] for r in raws for i in range(len(r) - n + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - n + 1):
            if seen[r[i:i + n]] > 1:
                gone[i:i + n] = b"\1" * n
        out.append(gone)
    return out


def test_suffix_dedup_is_exact(spark):
    from trustgrid.llm.suffix_dedup import op4_suffix_dedup
    a, b, c = words(5, 60), words(6, 60), words(7, 60)
    texts = EDGE + [a + b, b + a, a[:230] + "é" + c, c[40:] + a[:230], a[150:] + b[:120], a[100:] + c[:150],
                    c[30:] + b[:120], "z" * 700, "ab" * 400, a[:199], a[:200], words(8, 10) + a[:200] + words(9, 10)]
    raws = [(t or "").encode() for t in texts]
    rows = {r.doc_id: r for r in op4_suffix_dedup(table(spark, texts)).collect()}
    for i, (raw, gone) in enumerate(zip(raws, removed(raws, 200))):
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        spans = sum(1 for j, g in enumerate(gone) if g and (j == 0 or not gone[j - 1]))
        assert (rows[i].n_bytes, rows[i].n_removed, rows[i].n_spans) == (len(raw), sum(gone), spans), i
        assert rows[i].kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_anchors_do_not_depend_on_segments(spark):
    from trustgrid.llm.suffix_dedup import SEGMENT, op4_suffix_dedup, window_anchors
    r = random.Random(12)
    raw = np.frombuffer(r.randbytes(3000) + b"z" * 700 + r.randbytes(900), np.uint8)

    def anchors(segment):
        return [c.tolist() for c in map(np.concatenate, zip(*window_anchors(raw, 200, 100, segment)))]

    whole = anchors(1 << 20)
    assert len(set(whole[1])) == len(whole[1]) and all(anchors(n) == whole for n in (7, 100, 256, 1000))
    text = r.randbytes(SEGMENT + SEGMENT // 4 * 3).hex()            # 3.5 segments, nothing repeated
    a, b = op4_suffix_dedup(table(spark, [text, text[5000:5300]])).orderBy("doc_id").collect()
    assert (a.n_bytes, a.n_removed, a.n_spans, b.n_removed) == (len(text), 300, 1, 300)
    assert a.kept_sha256 == hashlib.sha256((text[:5000] + text[5300:]).encode()).hexdigest()


@pytest.mark.parametrize("length,gram", [(60, 30), (280, 120), (40, 40)])
def test_suffix_dedup_of_other_lengths(spark, length, gram):
    from trustgrid.llm.suffix_dedup import dedup_substrings
    r = random.Random(length)
    parts = [words(k, 40) for k in range(6)]
    texts = EDGE[:8] + [" ".join(p[r.randint(0, 40):r.randint(60, 240)] for p in r.sample(parts, 3)) for _ in range(60)]
    raws = [(t or "").encode() for t in texts]
    rows = {x.doc_id: x for x in dedup_substrings(table(spark, texts), length=length, gram=gram).collect()}
    for i, (raw, gone) in enumerate(zip(raws, removed(raws, length))):
        assert bytes(rows[i].kept) == bytes(x for x, g in zip(raw, gone) if not g), i
    with pytest.raises(ValueError):
        dedup_substrings(table(spark, texts), length=400, gram=100)


def test_merge_of_front_coded_runs():
    from trustgrid.llm.suffix_merge import common_prefix, front_coded_blocks, merged
    r = random.Random(3)
    runs, everything = [], []
    for k in range(5):
        keys = sorted({bytes(r.choices(b"ab", k=r.randint(0, 12))) for _ in range(40)})
        everything += keys
        runs.append([b for _, _, b in front_coded_blocks(keys, [(k, i) for i in range(len(keys))], [])])
    out = list(merged(runs))
    assert [s for _, s, _ in out] == sorted(everything)
    assert all(n == common_prefix(x, y) for (_, x, _), (n, y, _) in zip(out, out[1:]))


# --- shingle join ----------------------------------------------------------------------------

def near_copies():
    r = random.Random(11)
    base = words(20, 120).split()
    texts = list(EDGE)
    for _ in range(40):
        w = list(base)
        for _ in range(r.randint(0, 6)):
            w[r.randrange(len(w))] = words(r.random(), 1)
        texts.append(" ".join(w))
    for n in (1, 2, 3, 9, 11, 12, 25, 31, 47, 60):
        w = words(n, n).split()
        texts += [" ".join(w), " ".join(w).upper(), " ".join(w[:-1] + ["changed"]), " ".join(w + ["more"])]
    return texts


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80)])
def test_shingle_join_is_exact(spark, size, percent):
    from trustgrid.llm.shingle_join import jaccard_components
    texts = near_copies()
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    low = list(range(len(texts)))
    for _ in texts:
        for i, x in enumerate(sets):
            for j in range(i):
                if x and sets[j] and 100 * len(x & sets[j]) >= percent * len(x | sets[j]):
                    low[i] = low[j] = min(low[i], low[j])
    got = {r.doc_id: r for r in jaccard_components(table(spark, texts), size=size, percent=percent).collect()}
    for i in range(len(texts)):
        assert (got[i].n_shingles, got[i].component_id) == (len(sets[i]), low[i])


# --- decontamination ---------------------------------------------------------------------------

def test_decontamination_finds_edits(spark):
    from trustgrid.llm.decontaminate import edit_budget, find_leaks, least_distance, character_masks
    r = random.Random(4)
    items = [words(30 + i, 40) for i in range(5)] + [None, "", "short"]
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)], "item_id long, text string, doc_id string")
    texts = EDGE + [words(90, 50) + " " + items[0].upper().replace(" ", "\n ") + " " + words(91, 9), items[1][:100]]
    for edits in (1, 6, 11):
        t = list(items[2])
        for _ in range(edits):
            t[r.randrange(len(t))] = r.choice(["", "q", "zz"])
        texts.append(words(edits, 30) + " " + "".join(t) + " end")
    got = {(x.doc_id, x.item_id): x.distance for x in find_leaks(table(spark, texts), bench).collect()}

    def plain(item, text):
        row = [0] * (len(text) + 1)
        for i, c in enumerate(item, 1):
            new = [i]
            for j, d in enumerate(text, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
            row = new
        return min(row)

    want = {}
    for i, t in enumerate(texts):
        norm = " ".join((t or "").lower().split())
        if len(norm) > 5000:
            continue
        for k, item in enumerate(items):
            if item and len(item) >= 40 and plain(item, norm) <= edit_budget(item):
                want[i, k] = plain(item, norm)
    assert got == want and len(want) >= 3
    assert least_distance(character_masks("abcd"), 4, "xxabxcdxx")[0] == 1


def test_short_items_are_found_as_whole_words(spark):
    from trustgrid.llm.decontaminate import find_leaks
    items = ["What is 2 + 2?", "Paris", "ab", "x" * 39, "  ", "", None, "答案", "Café", "(no)", "z" * 40, "e"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [None, "", "q: WHAT  is\n2 + 2? a: 4", "what is 2 + 3?", "in paris.", "parisian, comparis", "x" * 39, "x" * 40,
             "cab abc (ab)", "这是答案吗", "café", "cafe\u0301", "cafés", "say(no)w", "z" * 39 + "y", "y" * 39, "parisx paris"]
    got = sorted((x.doc_id, x.item_id, x.distance, x.budget, x.ends_at)
                 for x in find_leaks(table(spark, texts), bench).collect())
    assert got == [(2, 0, 0, 0, 17), (4, 1, 0, 0, 8), (6, 3, 0, 0, 39), (8, 2, 0, 0, 11), (9, 7, 0, 0, 4), (10, 8, 0, 0, 4),
                   (13, 9, 0, 0, 7), (14, 10, 1, 2, 39), (16, 1, 0, 0, 12)]


# --- mixing ----------------------------------------------------------------------------------------

def test_mixing_spends_the_budget(spark):
    from pyspark.sql import functions as F
    from trustgrid.llm.source_mixing import document_levels, mix_sources
    texts = [words(i, 20 + i % 7) for i in range(60)] + [None, ""]
    docs = table(spark, texts, {i: ("en", "de", None)[i % 3] for i in range(62)},
                 {i: ("src0", "src1", "src5", None)[i % 4] for i in range(62)})
    mixed = mix_sources(docs, document_levels(), {"lang": {"en": 3}}, (1, 2), max_epochs=1)
    rows = mixed.withColumn("n", F.coalesce(F.ceil(F.octet_length("text") / 4), F.lit(0))).collect()
    assert len(rows) == 62 and set(docs.columns) <= set(mixed.columns)
    total, leaves = sum(r.n for r in rows), {r.mix_leaf: r.mix_budget for r in rows}
    assert sum(leaves.values()) == total // 2
    for leaf, budget in leaves.items():
        held = sum(r.n for r in rows if r.mix_leaf == leaf)
        taken = sum(r.n * r.mix_copies for r in rows if r.mix_leaf == leaf)
        assert budget <= held and taken <= budget
        assert all(r.mix_copies or taken + r.n > budget or r.n == 0 or taken < budget
                   for r in rows if r.mix_leaf == leaf)


# --- packing -------------------------------------------------------------------------------------------

def test_packing_keeps_groups_and_levels_sizes(spark):
    from trustgrid.llm.bin_packing import best_fit_decreasing, op9_bin_packing, pack_shards
    texts = EDGE + [words(i, 10 + i % 50) for i in range(300)] * 2 + ["the same"] * 50
    rows = op9_bin_packing(table(spark, texts)).collect()
    assert len(rows) == len(texts)
    by_text, size, slots = {}, {}, {}
    for r in rows:
        by_text.setdefault(texts[r.doc_id] or "", set()).add(r.shard)
        size[r.shard] = size.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.size == len((texts[r.doc_id] or "").encode()) + 16
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    large = (max(size, key=size.get),)           # the long text is alone
    rest = [v for k, v in size.items() if k not in large]
    assert len(size) == 40 and max(rest) - min(rest) < 0.2 * max(rest)
    assert best_fit_decreasing([(6, 1), (5, 1), (4, 1), (3, 1), (2, 1)], 10) == [[(0, 1)], [(1, 1)], [(0, 1)], [(1, 1)], [(1, 1)]]
    fixed = pack_shards(table(spark, texts), None, capacity=30_000).groupBy("shard").sum("size").collect()
    assert len(fixed) <= 2 + sum(size.values()) // 30_000


def plain_best_fit(sizes, capacity):
    """Bin of each size, one after the other, by a search through all bins."""
    room, out = [], []
    for s in sizes:
        holds = [(r, i) for i, r in enumerate(room) if r >= s]
        if not holds:
            room.append(max(capacity, s))
            holds = [(room[-1], len(room) - 1)]
        i = min(holds)[1]
        room[i] -= s
        out.append(i)
    return out


def test_runs_are_packed_as_their_groups_one_by_one():
    import random
    from collections import Counter
    from trustgrid.llm.bin_packing import best_fit_decreasing, level_bins
    rng = random.Random(5)
    for _ in range(20):
        sizes = sorted((rng.choice([16, 17, 40, 90, 333, rng.randint(16, 900)]) for _ in range(2000)), reverse=True)
        runs = [(s, k) for s, k in Counter(sizes).items()]
        shares = best_fit_decreasing(runs, 5000)
        assert [b for own in shares for b, k in own for _ in range(k)] == plain_best_fit(sizes, 5000)
        level = level_bins(runs, 12)
        load = Counter()
        for (size, many), own in zip(runs, level):
            assert sum(k for _, k in own) == many
            for b, k in own:
                load[b] += size * k
        assert len(load) == 12 and max(load.values()) - min(load.values()) <= 900
    assert level_bins([(1000, 2), (10, 5)], 3) == [[(0, 1), (1, 1)], [(2, 5)]]
    assert level_bins([], 3) == [] and best_fit_decreasing([(5, 3)], 5, 2) is None


def test_groups_of_the_query_are_packed_exactly(spark):
    from trustgrid.llm.bin_packing import best_fit_decreasing, pack_shards
    texts = [words(i, 10 + i % 50) for i in range(300)] + ["twin"] * 7 + [None, "", "x"]
    rows = pack_shards(table(spark, texts), None, capacity=5000).collect()
    loads, groups = {}, {}
    for r in rows:
        loads[r.shard] = loads.get(r.shard, 0) + r.size
        groups[texts[r.doc_id] or ""] = groups.get(texts[r.doc_id] or "", 0) + r.size
    sizes = sorted(groups.values(), reverse=True)
    want = {}
    for size, b in zip(sizes, plain_best_fit(sizes, 5000)):
        want[b] = want.get(b, 0) + size
    assert loads == want


# --- privacy -------------------------------------------------------------------------------------------------

def test_surrogates(spark):
    from trustgrid.llm.pii_surrogates import replace_pii
    texts = EDGE + ["mail Bob.1@Mail.example.com or bob.1@mail.example.com, 10.1.2.3 and 10.1.2.4.",
                    "card 4111 1111 1111 1111 = 4111111111111111, call +1 (487) 555-7209 now",
                    "Mrs. Anna Smith met Г-жа Анна Петрова and Herr Jonas Weber", "bob.1@mail.example.com" * 1]
    out = {r.doc_id: r for r in replace_pii(table(spark, texts), "k").collect()}
    n = len(EDGE)
    assert out[0].clean_text is None and all(out[i].clean_text == EDGE[i] for i in range(1, n))
    a = out[n].entities
    assert [e.kind for e in a] == ["email", "email", "ip", "ip"]
    assert a[0].surrogate.lower() == a[1].surrogate == out[n + 3].entities[0].surrogate
    assert a[2].surrogate != a[3].surrogate and all(0 < int(x) < 255 for x in a[2].surrogate.split("."))
    c = out[n + 1].entities
    assert [e.kind for e in c] == ["card", "card", "phone"]
    assert c[0].surrogate.replace(" ", "") == c[1].surrogate and c[0].surrogate.count(" ") == 3
    assert c[2].surrogate.startswith("+1 (") and len(c[2].surrogate) == len(c[2].mention)
    names = out[n + 2].entities
    assert [e.surrogate.split()[0] for e in names] == ["Mrs.", "Г-жа", "Herr"]
    assert all(w not in out[n + 2].clean_text for w in ("Smith", "Петрова", "Weber"))
    for i in range(n, len(texts)):
        text = texts[i]
        for e in out[i].entities:
            assert e.mention not in out[i].clean_text
            text = text.replace(e.mention, e.surrogate, 1)
        assert out[i].clean_text == text


def plain_luhn(number):
    digits = [int(c) for c in number if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10


def plain_modulo_97(iban):
    iban = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def test_check_digits_hold_where_they_held(spark):
    from trustgrid.llm.pii_surrogates import replace_pii
    cards = ["4111 1111 1111 1111", "5500-0000-0000-0004", "340000000000009", "4111111111111112", "6011000000000004"]
    ibans = ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "FR14 2004 1010 0505 0001 3M02 606", "DE00 3704 0044 0532 0130 00"]
    out = replace_pii(table(spark, [f"pay {x} now" for x in cards + ibans]), "k").collect()
    found = {r.doc_id: r.entities[0] for r in out}
    for i, card in enumerate(cards):
        e = found[i]
        assert e.kind == "card" and e.surrogate != card and [c.isdigit() for c in e.surrogate] == [c.isdigit() for c in card]
        assert plain_luhn(e.surrogate) == 0 or plain_luhn(card) != 0
    for i, iban in enumerate(ibans, len(cards)):
        e = found[i]
        assert e.kind == "iban" and e.surrogate != iban and e.surrogate[:2] == iban[:2] and len(e.surrogate) == len(iban)
        assert plain_modulo_97(e.surrogate) == 1 or plain_modulo_97(iban) != 1


def test_more_names_than_short_surrogates(spark):
    """70,000 family names of one gender and script: 65,536 surrogates of four syllables are too few; none is a tag."""
    from pyspark.sql import functions as F
    from trustgrid.llm.pii_surrogates import normal_form, redrawn_entities, surrogate
    letters = "abcdefghijklmnopqrst"
    name = F.concat(F.lit("Mr X"), *[F.substr(F.lit(letters), F.pmod(F.floor(F.col("id") / 20 ** i), F.lit(20)).cast("int") + 1, F.lit(1))
                                     for i in range(4)])
    entities = spark.range(70_000).select(F.lit("name").alias("kind"), name.alias("mention")).withColumn(
        "norm", normal_form(F.col("mention"), F.col("kind")))
    drawn = entities.join(redrawn_entities(entities, "k"), ["kind", "norm"], "left").select(
        surrogate(F.col("mention"), F.col("kind"), F.col("norm"), F.coalesce("attempt", F.lit(0)), "k").alias("s"))
    r = drawn.agg(F.count("*").alias("n"), F.count_distinct("s").alias("distinct"), F.count_if(F.col("s").contains("[")).alias("tags")).first()
    assert (r["n"], r["distinct"], r["tags"]) == (70_000, 70_000, 0)


def test_phone_numbers_keep_their_identity_in_any_layout(spark):
    from trustgrid.llm.pii_surrogates import replace_pii
    texts = ["+49 30 1234567 or +49301234567, +4 930 123 4567, +49-30-12345.67", "+1 (487) 555-7209, +14875557209", "+35312345678"]
    digits = lambda e: e.surrogate.replace("+", "").translate({ord(c): None for c in " .-()"})
    out = [r.entities for r in replace_pii(table(spark, texts), "k").orderBy("doc_id").collect()]
    assert [len(e) for e in out] == [4, 2, 1] and all(len({digits(e) for e in es}) == 1 for es in out)
    assert all(e.kind == "phone" and digits(e).startswith(code) for es, code in zip(out, ("49", "1", "353")) for e in es)
    assert all(digits(e) != "".join(c for c in e.mention if c.isdigit()) for es in out for e in es)
    # so few numbers that many draws collide: equal in both layouts, distinct, no real ones
    r = random.Random(9)
    numbers = [f"{n:04d}" for n in r.sample(range(10_000), 900)]
    texts = [f"a +49 {n[:2]} {n[2:]} b" for n in numbers] + [f"a +49{n} b" for n in numbers]
    rows = {x.doc_id: x.entities[0] for x in replace_pii(table(spark, texts), "k").select("doc_id", "entities").collect()}
    drawn = [digits(rows[i]) for i in range(1800)]
    assert drawn[:900] == drawn[900:] and len(set(drawn)) == 900
    assert not set(drawn) & {"49" + n for n in numbers}


def test_colliding_draws_are_redrawn(spark):
    from pyspark.sql import functions as F
    from trustgrid.llm.pii_surrogates import ATTEMPTS, redrawn_entities, surrogate
    rows = [("email", f"{a}@{b}.de", f"{a}@{b}.de") for a in "abcdefghijklm" for b in "abcdefgh"]
    ents = spark.createDataFrame(rows, "kind string, norm string, mention string")
    again = redrawn_entities(ents, "k")
    final = ents.join(again, ["kind", "norm"], "left").withColumn("attempt", F.coalesce("attempt", F.lit(0)))
    got = final.select("norm", surrogate(F.col("mention"), F.col("kind"), F.col("norm"), F.col("attempt"), "k").alias("s"),
                       "attempt").collect()
    assert len({r.s for r in got}) == len(rows) and max(r.attempt for r in got) >= 1
    assert not {r.s for r in got if r.attempt < ATTEMPTS} & {r[1] for r in rows}


# --- models -------------------------------------------------------------------------------------------------------

def test_forward_sums_all_segmentations():
    from trustgrid.llm.language_id import Lattice, word_scores
    pieces = ["a", "b", "ab", "ba", "aba", "▁", "▁a"]
    probs = np.array([[0.2], [0.1], [0.3], [0.05], [0.15], [0.1], [0.1], [1e-9]])

    def total(s):
        if not s:
            return 1.0
        out = 0.0
        for k in range(1, len(s) + 1):
            if s[:k] in pieces:
                out += probs[pieces.index(s[:k]), 0] * total(s[k:])
            elif k == 1:
                out += 1e-9 * total(s[1:])
        return out

    ws = ["abab", "ba", "xa", "b", "abaabbaba" * 3]
    got = word_scores(ws, Lattice(pieces), probs)[:, 0]
    assert np.allclose(got, [np.log(total("▁" + w)) for w in ws])


def test_lattice_lists_every_piece():
    """The walk over the tree of pieces against a look-up of every substring."""
    from trustgrid.llm.language_id import Lattice
    rnd = random.Random(5)
    pieces = sorted({"".join(rnd.choice("abc\u2581é") for _ in range(rnd.randint(1, 4))) for _ in range(60)})
    words = ["", "x", "zzz"] + ["".join(rnd.choice("abcé\u2581x😀") for _ in range(rnd.randint(0, 9))) for _ in range(200)]
    for vocabulary in (pieces, []):
        index = {p: i for i, p in enumerate(vocabulary)}
        want = {(j, j - i, w, index.get(word[i:j], -1)) for w, word in enumerate(words) for i in range(len(word))
                for j in range(i + 1, len(word) + 1) if word[i:j] in index or j == i + 1}
        rows = [(end, size, int(w), int(p)) for end, size, ws, ps in Lattice(vocabulary).edges(words)
                for w, p in zip(ws, ps)]
        assert len(rows) == len(set(rows)) and set(rows) == want
        assert [r[:2] for r in rows] == sorted(r[:2] for r in rows)
    assert Lattice(pieces).edges([]) == []


def test_language_and_quality_on_held_out_rows(spark):
    from trustgrid.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    lang = QUERIES["op2_language_id"](spark, sf).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in lang if r.held_out]
    assert len(lang) == docs.count() and sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op1_quality_trees"](spark, sf).collect() if r.held_out and r.doc_id in labels]
    good = [r.score for r in rows if labels[r.doc_id] == 1]
    bad = [r.score for r in rows if labels[r.doc_id] == 0]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.9


def test_models_on_edge_rows(spark):
    from trustgrid.llm.language_id import identify, learn
    from trustgrid.llm.quality_trees import fit, op1_quality_trees
    model = learn([("en", "the cat and the hat"), ("de", "die katze und der hut")], ["▁", *"abcdefghijklmnopqrstuvwxyz"])
    rows = identify(table(spark, EDGE).drop("score"), model).collect()
    assert [r.lang_pred == "und" for r in rows[:6]] == [True, True, True, False, False, True]
    none = identify(table(spark, EDGE).drop("score"), learn([], ["a"])).collect()
    assert {r.lang_pred for r in none} == {"und"}
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in op1_quality_trees(table(spark, EDGE), labels).collect()} == {0.5}
    x = np.arange(200.0)[:, None]
    forest = fit(x, (x[:, 0] > 90).astype(float), trees=20, depth=2, least=2)
    assert ((forest.score(x) > 0.5) == (x[:, 0] > 90)).all()


def test_long_unknown_runs_leave_the_other_words_their_say(spark):
    from trustgrid.llm.language_id import UNKNOWN, Lattice, identify, learn, word_scores
    run = "".join(chr(0x4e00 + 7 * i) for i in range(60))
    got = word_scores([run], Lattice(["a"]), np.array([[0.5], [UNKNOWN]]))
    assert np.allclose(got, 61 * np.log(UNKNOWN))
    letters = ["▁", *"abcdefghijklmnopqrstuvwxyz"]
    for extra in ("", " " + run, " " + "qxqz" * 30):        # in the sample as well
        model = learn([("de", "die katze und der hut" + extra), ("en", "the cat and the hat" + extra)], letters)
        assert np.isfinite(model.probs).all() and (model.probs[:-1].sum(axis=0) > 0.99).all()
        texts = ["the cat that hath " * 9 + run, "der hund und die kunde " * 9 + run, run, "qxqz" * 30]
        rows = identify(table(spark, texts).drop("score"), model).orderBy("doc_id").collect()
        assert [r.lang_pred for r in rows[:2]] == ["en", "de"]
        assert all(0 <= r.score <= 1 for r in rows)
        assert rows[0].score > 0.9 and rows[1].score > 0.9


def test_language_stage_drops_noise_and_keeps_the_rest(spark):
    from corpus_pipeline import language_stage
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    r = random.Random(8)
    noise = [" ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(2, 9))) for _ in range(n)) for n in (5, 40, 900)]
    noise += ["Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan, heille on annettu järki",
              "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw, są obdarzeni rozumem",
              "Все люди рождаются свободными и равными в своем достоинстве и правах", "人人生而自由在尊严和权利上一律平等" * 4]
    mixed = docs.unionByName(spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(noise)],
                                                   "doc_id long, text string, lang string"))
    kept = {x.doc_id for x in language_stage(spark, mixed, "").select("doc_id").collect()}
    ids = {x.doc_id for x in docs.filter("text rlike '[a-zA-Z]'").select("doc_id").collect()}
    assert not {i for i in kept if i < 0} and len(ids - kept) <= 0.002 * len(ids)


def test_words_are_letters_and_marks():
    from trustgrid.llm.language_id import words_of
    assert words_of("x² ½ Ⅳ ① ³") == ["x"] and words_of("\u0301\u0301 ①") == []
    assert words_of("cafe\u0301s का_б1в Don't") == ["cafe\u0301s", "का", "б", "в", "don", "t"]


def test_stages_on_null_and_repeated_ids(spark, scratch):
    from corpus_pipeline import decontamination_stage, near_duplicate_stage
    a, b, c, d, e = (words(200 + i, 60) for i in range(5))
    rows = [(None, a), (None, a + " more"), (1, b), (1, b), (1, c), (2, b), (3, d), (None, d), (None, e), (4, None), (5, ""),
            (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(map(tuple, near_duplicate_stage(spark, docs, "").collect()), key=str)
    alone = [(1, b), (1, c), (3, d), (None, e), (4, None), (5, ""), (None, None)]
    assert kept in [sorted(alone + [x], key=str) for x in rows[:2]]
    spark.createDataFrame([(0, a), (1, b)], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    kept = sorted(map(tuple, decontamination_stage(spark, docs, scratch).collect()), key=str)
    assert kept == sorted([x for x in rows if not (x[1] or "").startswith((a, b))], key=str)


# --- empty tables ----------------------------------------------------------------------------------------------------

def test_empty_tables(spark, empty):
    from trustgrid.llm.bin_packing import op9_bin_packing
    from trustgrid.llm.decontaminate import op10_decontaminate
    from trustgrid.llm.language_id import op2_language_id
    from trustgrid.llm.lz_fingerprint import op5_lz_fingerprint
    from trustgrid.llm.pii_surrogates import op3_pii_surrogates
    from trustgrid.llm.secret_scan import op6_secret_scan
    from trustgrid.llm.shingle_join import op7_shingle_join
    from trustgrid.llm.source_mixing import op8_source_mixing
    from trustgrid.llm.suffix_dedup import op4_suffix_dedup
    bench = spark.createDataFrame([], "item_id long, text string")
    for op in (op2_language_id, op3_pii_surrogates, op4_suffix_dedup, op5_lz_fingerprint, op6_secret_scan,
               op7_shingle_join, op8_source_mixing, op9_bin_packing, lambda d: op10_decontaminate(d, bench)):
        assert op(empty).count() == 0
