"""Filter audit, BPE by a lexicon and fill-in-middle: against SQL, the libraries and brute force, and on odd tables."""

import hashlib
import itertools
import random
import re

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from siftwell.llm import audit, bytepair, infill, queries
from tests.llm.test_llm import SF, by_id, documents, empty, odd, same_as_sql, texts  # noqa: F401

BPE = public_tokenizers.path("byte_bpe_50k.json")
SPACE = re.compile("[\x20\x09-\x0d]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_swaps_visit_every_order_once():
    for n in range(1, 7):
        order, seen = list(range(n)), [tuple(range(n))]
        for left in audit.swaps(n):
            order[left], order[left + 1] = order[left + 1], order[left]
            seen.append(tuple(order))
        assert sorted(seen) == list(itertools.permutations(range(n)))


def audited(rows, labels):
    """Every order applied to every row, one filter after another."""
    firsts = {}
    for k, text, _ in rows:
        if k is not None:
            firsts[text or ""] = min(k, firsts.get(text or "", k))
    fails = []
    for k, text, _ in rows:
        text = text or ""
        words = [w for w in SPACE.split(text) if w]
        capitals = sum("A" <= c <= "Z" for c in text)
        found = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * capitals > 10 * len(text), "D": bool(re.search("[#$%&*|]", text)), "E": k is not None and k > firsts[text]}
        fails.append("".join(f for f, bad in found.items() if bad))
    good = {k for k, q, _ in labels if k is not None and q == 1}
    toxic = {k for k, _, t in labels if k is not None and t == 1}
    out, shapley = {}, {}
    for part in {p or "" for *_, p in rows}:
        mine = [(k, f) for (k, _, p), f in zip(rows, fails, strict=True) if (p or "") == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = list(mine)
            for step, f in enumerate(order, 1):
                gone = [k for k, x in left if f in x]
                left = [(k, x) for k, x in left if f not in x]
                redundant = sum(f in x for _, x in mine) - len(gone)
                out[part, order, step] = (len(left), len(gone), redundant, sum(x == f for _, x in mine), sum(k in good for k in gone), sum(k in toxic for k in gone))
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
    return {(p, o, s): (*v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items()}


def table(df):
    got = df.collect()
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r[m] for m in [*audit.MEASURES, "shapley"]) for r in got}
    assert len(found) == len(got)
    return found


def test_filter_audit(spark, empty):  # noqa: F811
    same_as_sql(spark, "op11_filter_audit")
    many = " ".join(f"w{k}" for k in range(120))
    rows = [
        (1, None, "en"), (2, "", None), (3, "", "en"), (4, many, "de"), (5, many, "en"), (5, many, "en"), (5, many, "fr"), (None, many, "en"), (None, None, None), (None, "only # null", "en"), (6, "LOUD " * 150, "en"),
        (7, "a$ " + many, ""), (8, "a$ " + many, "de"), (8, "other text", "de"), (9, "ÄÖÜ é " * 80, "de"), (10, many + "\x0b\x0c x", "xx"), (11, "word " * 40_000, "en"), (12, "x" * 2_000_000, "en"),
    ]
    labels = [(1, 1, 0), (3, 0, 1), (5, 1, 1), (5, 0, 0), (8, None, 1), (7, 1, None), (99, 1, 1), (None, 1, 1)]
    docs = spark.createDataFrame([(*r, 7, "c") for r in rows], "doc_id long, text string, lang string, n long, mask string").repartition(3)
    marks = spark.createDataFrame([(*r, "k") for r in labels], "doc_id long, quality int, toxic int, key string")
    assert table(audit.interactions(audit.masks(docs, marks))) == audited(rows, labels)
    assert table(audit.interactions(audit.masks(docs, marks.limit(0)))) == audited(rows, [])
    assert audit.interactions(audit.masks(empty.selectExpr("*", "'en' AS lang"), marks)).count() == 0


def test_walk_counts_a_filter_as_often_as_it_removes():
    rng = np.random.default_rng(3)
    n, good, toxic = rng.integers(0, 50, (3, 4, 32))
    names, steps, shapley = audit.Walk(n, good, toxic).orders()
    assert len(set(names)) == 120 and steps.shape == (120, 5, 6, 4)
    for k in range(5):
        assert (shapley[k] == sum(steps[i, name.index("ABCDE"[k]), 1] for i, name in enumerate(names))).all()
    assert (shapley.sum(0) == 120 * n[:, 1:].sum(1)).all()  # the filters share what all of them remove


PARTS = ["'", "'s", "'re", "'ve", "'ll", "'d", "re", "s", "t", "a", "b", "Z", " ", "  ", "\n", "\t", "\r\n", "1", "23", "!", "?", "''", "<|endoftext|>", "<|endof", "text|>", "é", "你", " ", " ", "　", "\x1c", "\x85", "😀", "Ᲊ", "\x00", "ʼ", "³", "́"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


def test_pretokens_and_merges_equal_the_library(library):
    rng = random.Random(11)
    mixed = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(10_000)]
    mixed += ["".join(chr(rng.choice([rng.randrange(0x20, 0x3000), rng.randrange(0xE000, 0x20000)])) for _ in range(40)) for _ in range(500)]
    bpe, classes = bytepair.ByteLevel(BPE), bytepair.code_point_classes()
    wanted = [e.ids for e in library.encode_batch(mixed, add_special_tokens=False)]
    words = sorted({w.encode() for text in mixed[:200] for w in text.split() if 0 < len(w.encode()) <= bytepair.LEXICON_BYTES})
    for lexicon in (words, words[:1], []):
        made = bytepair.transducer(lexicon, [tuple(bpe.merged(w)) for w in lexicon]) | {"classes": classes}
        assert bytepair.Encoder(bpe, made).ids(pa.array(mixed)).to_pylist() == wanted
    lists = wanted + [[rng.randrange(50_257) for _ in range(9)] for _ in range(2_000)]
    assert bytepair.Decoder(bpe).texts(pa.array(lists, pa.list_(pa.int32()))).to_pylist() == [library.decode(x, skip_special_tokens=False) for x in lists]
    assert bytepair.Decoder(bpe).texts(pa.array([None, [], [-1, 64, 10**6]], pa.list_(pa.int32()))).to_pylist() == [None, "", "a"]


def minimal_states(words, ids):
    """The states of the smallest transducer: beginnings with the same endings, once the ids in common are put out."""

    def behind(prefix):
        rest = [(w[len(prefix):], x) for w, x in zip(words, ids, strict=True) if w.startswith(prefix)]
        common = 0
        while all(len(x) > common and x[common] == rest[0][1][common] for _, x in rest):
            common += 1
        return tuple((w, x[common:]) for w, x in rest)

    return len({behind(w[:k]) for w in words for k in range(len(w) + 1)})


def test_transducer_is_minimal_and_exact():
    rng = random.Random(2)
    for _ in range(30):
        words = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 6))) for _ in range(40)})
        ids = [tuple(rng.randrange(3) for _ in range(rng.randint(1, 3))) for _ in words]
        made = bytepair.unpacked(np.frombuffer(bytepair.packed(bytepair.transducer(words, ids)), np.uint8))
        probes = words + [bytes(rng.choice(b"abcd") for _ in range(rng.randint(1, 8))) for _ in range(50)]
        data = np.frombuffer(b"".join(probes), np.uint8)
        stop = np.cumsum([len(p) for p in probes])
        known, (who, step, what) = bytepair.walk(data, np.append(0, stop[:-1]), stop, made)
        assert known.tolist() == [p in words for p in probes]
        told = {k: [] for k in range(len(probes))}
        for w, _, o in sorted(zip(who.tolist(), step.tolist(), what.tolist(), strict=True)):
            told[w] += made["pool"][made["first"][o] : made["first"][o + 1]].tolist()
        assert all(tuple(told[k]) == ids[words.index(p)] for k, p in enumerate(probes) if known[k])
        roots = {tuple(x[:0]) for x in ids}
        assert len(roots) == 1 and len(made["end"]) <= minimal_states(words, ids) + 1  # the root puts nothing out before its arcs
    shared = [a + b"ing" for a in (b"talk", b"walk")]
    assert len(bytepair.transducer(shared, [(1, 9), (2, 9)])["end"]) == 8  # root, t and w on; then one tail


def test_bytepair(spark, odd, empty, texts, library):  # noqa: F811
    found = by_id(queries.op12_bytepair(spark, SF))
    assert found.keys() == texts.keys()
    for k, text in texts.items():
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert (found[k]["n_tokens"], found[k]["ids_sha256"]) == (len(ids), sha(",".join(map(str, ids))))
        assert found[k]["decoded_sha256"] == sha(library.decode(ids, skip_special_tokens=False)) == sha(text or "")
    name = bytepair.build_lexicon(odd, BPE, most_words=20)
    for r in bytepair.decode(bytepair.encode(odd, BPE, name), BPE).collect():
        assert r["token_ids"] == library.encode(r["text"] or "", add_special_tokens=False).ids and r["decoded"] == (r["text"] or "")
    assert set(bytepair.encode(odd, BPE, name).columns) == {*odd.columns, "token_ids"}
    for few in (20, 0):
        name = bytepair.build_lexicon(empty, BPE, most_words=few)
        assert bytepair.round_trip(empty, BPE, name).count() == 0
        assert bytepair.round_trip(odd, BPE, name).where("decoded <> ''").count() == odd.where("text <> ''").count()


def test_lexicon_holds_the_most_frequent_words(spark):
    docs = spark.createDataFrame([(1, "tie tie toe toe"), (2, None), (3, " tie"), (4, "x" * 300)], "doc_id long, text string")
    classes = bytepair.share(spark, bytepair.packed({"classes": bytepair.code_point_classes()}))
    counts = {bytes(r["word"]): r["n"] for r in bytepair.count_words(docs, BPE, classes).collect()}
    assert counts == {b"tie": 1, b" tie": 2, b" toe": 2}
    first, again = (bytepair.build_lexicon(docs, BPE, most_words=2) for _ in range(2))
    assert first == again  # equal tables share one file
    assert len(bytepair._files(first)["end"]) == 5  # " tie" and " toe": the arcs i and o end in one state


def test_frequent_words_are_whole_classes(spark):
    counted = spark.createDataFrame([(f"w{k}".encode(), n) for k, n in enumerate([1] * 9 + [2] * 3 + [1000, 1001, 5])], "word binary, n long")
    taken = {most: sorted(r["n"] for r in bytepair.frequent(counted, most).collect()) for most in (0, 1, 2, 3, 5, 6, 14, 15)}
    assert taken == {0: [], 1: [], 2: [1000, 1001], 3: [5, 1000, 1001], 5: [5, 1000, 1001], 6: [2, 2, 2, 5, 1000, 1001], 14: [2, 2, 2, 5, 1000, 1001], 15: sorted([1] * 9 + [2] * 3 + [1000, 1001, 5])}


def test_bytepair_on_very_long_texts(spark, library):
    long = ["你好" * 60_000, "1" * 200_000, "'s" * 100_000, " " * 300_000 + "end", "a" * 100_000]
    docs = spark.createDataFrame(list(enumerate(long)), "doc_id long, text string")
    for r in bytepair.round_trip(docs, BPE).collect():
        assert r["token_ids"] == library.encode(long[r["doc_id"]], add_special_tokens=False).ids and r["decoded"] == long[r["doc_id"]]


def test_infill(spark, odd, empty):  # noqa: F811
    wanted = duckdb.connect().sql(queries.OP13_SQL.replace("FROM documents", f"FROM '{SF}/documents.parquet'")).fetchall()
    assert sorted(map(tuple, queries.op13_infill(spark, SF).collect())) == sorted(wanted)
    rows = infill.transform(odd)
    assert rows.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    wanted = sorted((str(r["doc_id"]), r["text"] or "") for r in odd.collect())
    back = rows.select("doc_id", infill.restored(rows["output"], rows["form"]).alias("text")).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in back) == wanted
    assert infill.transform(empty).count() == 0
    marks = ["<P>", "a<S>b", "x" * 50 + "<M>", "<P", "S>" * 40, "<" * 60, "P><S" * 30, "a\n\n\r\n\x00 é́😀👨‍👩‍👧" * 40, None, ""]
    docs = spark.createDataFrame([(k, m) for k, m in enumerate(marks * 30)], "doc_id long, text string")
    found = infill.transform(docs, spm_percent=50)
    forms = set()
    for r in found.select("*", infill.restored(found["output"], found["form"]).alias("text")).collect():
        text = marks[r["doc_id"] % len(marks)] or ""
        assert r["text"] == text and r["n"] == len(text)
        if r["form"] == "plain":
            assert r["output"] == text and r["prefix_chars"] is None
        else:
            digest = sha(f"1:{r['doc_id']}")
            a, b = sorted(int(digest[k : k + 8], 16) % (len(text) + 1) for k in (0, 8))
            prefix, middle, suffix = text[:a], text[a:b], text[b:]
            assert (r["prefix_chars"], r["middle_chars"]) == (a, b - a)
            assert r["output"] == (f"<P>{prefix}<S>{suffix}<M>{middle}" if r["form"] == "psm" else f"<S>{suffix}<P>{prefix}<M>{middle}")
            assert not any(m in text for m in ("<P>", "<S>", "<M>"))
        forms.add(r["form"])
    assert forms == {"plain", "psm", "spm"}


def test_code_points_are_isolated():
    for text in ("", "a", "\n\n\n", "\r\n" * 3000, "é́" * 2000, "😀‍" * 1500, "\x00\x85 "):
        sizes = infill.lengths(text)
        assert sizes.sum() == len(text)
        assert [k for block in range(len(sizes)) for k in infill.offsets(text, block).tolist()] == list(range(len(text)))
        for a, b in ((0, 0), (len(text), 0), (len(text) // 2, len(text) // 3), (255, 256), (257, 512)):
            n, prefix, middle, suffix = infill.cut(text, a, b)
            low, high = sorted((a % (n + 1), b % (n + 1)))
            assert (prefix, middle, suffix) == (text[:low], text[low:high], text[high:])
