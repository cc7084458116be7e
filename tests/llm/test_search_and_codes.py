"""Hard negatives, speculative encoding and vector codes against their contracts done plainly."""

import random

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from fraudloom.llm import covertree, queries, speculative, vectorcode
from fraudloom.llm.speculative import Vocabulary

ROWS = "vec_id bigint, label int, embedding array<double>"


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is None, v) for v in r))


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(queries.BYTE_BPE)


# ---- speculate and verify -------------------------------------------------------------
def _odd_texts():
    rnd = random.Random(7)
    alphabet = "abcdefghijkl  '.,0123\n\tÉß日"
    texts = [None, "", "a", " ", "<|endoftext|>", "x<|endoftext|> y<|endoftext|><|endoftext|>\n", "  two  \n x ", "\x00\x01",
             "İ ß é́ \x1c\x85  x", "b" * 3000, "日本語テキスト " * 50, "don't we'll 'S ₝'s \U00018f56's \U00011dba's", " " * 500,
             "\n" * 100, "ab" * 100 + " " + "😀" * 40, "zyx" * 40_000, "long text " * 60_000]
    texts += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 200))) for _ in range(300)]
    return texts + [bytes(rnd.randrange(256) for _ in range(60)).decode("latin1") for _ in range(100)]


def test_speculative_query_equals_the_library(spark, tmp_path):
    rows = list(enumerate(_odd_texts())) + [(3, " "), (None, "no id"), (3, " ")]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op12_speculative_bpe(spark, str(tmp_path))
    assert _sorted(found.collect()) == _sorted(brute.library_bpe(rows))


def test_proposals_that_fail_are_merged(vocabulary):
    rnd = random.Random(3)
    words = [bytes(rnd.choice(b"abcdefgh ") for _ in range(rnd.randint(1, 90))) for _ in range(3000)]
    ids, ends = vocabulary.encode_words(words)
    numbers, merged = vocabulary.merge(words)
    assert ids.tolist() == merged.tolist() and np.bincount(numbers).cumsum().tolist() == ends.tolist()
    proposed_numbers, proposed = vocabulary.propose(words)
    at = np.split(proposed, np.bincount(proposed_numbers).cumsum()[:-1])
    same = sum(a.tolist() == b.tolist() for a, b in zip(at, np.split(ids.astype(int), ends[:-1])))
    assert 0 < same < len(words)  # some proposals hold, some do not


def test_library_and_own_cut_of_every_settled_character(vocabulary):
    for code in [*range(0x250), 0x2014, 0x3042, 0x1F600]:
        for text in (f"a{chr(code)}'s", f" {chr(code)}'s 1{chr(code)}", f"x {chr(code)} {chr(code)}{chr(code)}"):
            spans = vocabulary.tokenizer.pre_tokenizer.pre_tokenize_str(text)
            assert vocabulary.words(text) == [text[a:b] for _, (a, b) in spans], hex(code)


def test_decoding_of_any_ids(spark, vocabulary):
    rnd = np.random.default_rng(2)
    ids = [rnd.integers(0, 50_257, n).astype("<u4") for n in (0, 1, 5, 400)] + [np.array([60_000, 64, 2**32 - 1], "<u4")]
    rows = [(i, bytearray(v.tobytes()), "kept") for i, v in enumerate(ids)] + [(9, None, None)]
    got = speculative.decode(spark.createDataFrame(rows, "n int, ids binary, decoded string"), queries.BYTE_BPE).collect()
    library = vocabulary.tokenizer
    for row, v in zip(got, ids):
        assert bytes(row.decoded).decode() == library.decode([i for i in v.tolist() if i < 50_257], skip_special_tokens=False)
    assert bytes(got[-1].decoded) == b"" and len(got) == 6


def test_columns_pass_through_encoding(spark):
    rows = [(1, "some text", b"old", "a"), (2, None, None, None)]
    found = speculative.encode(spark.createDataFrame(rows, "piece int, text string, ids binary, h1 string"), queries.BYTE_BPE)
    assert found.columns == ["piece", "text", "h1", "ids"]
    assert [(r.piece, r.text, r.h1, len(r.ids)) for r in found.collect()] == [(1, "some text", "a", 8), (2, None, None, 0)]


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        Vocabulary(public_tokenizers.path("word_bpe_49k.json"))


# ---- cover tree -------------------------------------------------------------------
def _vectors(n=700, dim=8, seed=1):
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(n, dim)) * rnd.uniform(0.2, 2, (n, 1))
    x[n // 2:] = x[rnd.integers(0, 20, n - n // 2)] + 0.02 * rnd.normal(size=(n - n // 2, dim))
    rows = [(i, int(rnd.integers(0, 4)), v.tolist()) for i, v in enumerate(x)]
    odd = [(None, 1, [1.0] * dim), (7000, None, [1.0] * dim), (7100, 1, None), (7200, 1, [float("nan")] * dim),
           (7300, 2, [None] + [1.0] * (dim - 1)), (7400, 1, []), (7500, 1, [0.0] * dim), (7600, 3, [1.0, 2.0]), (7700, 9, [0.5] * dim),
           (7800, 1, [float("inf")] * dim), (7900, 1, [1e9] * dim)]
    big = [(100 * k, k % 2, [float(2**21 + k)] * 3) for k in range(90, 94)]  # beyond exact double products
    return rows + odd + big + rows[:3] + rows[100:101] * 2


@pytest.mark.parametrize("shard_bytes", [3_000, 1 << 25])
def test_hard_negatives(spark, shard_bytes):
    rows = _vectors()
    table = spark.createDataFrame([(*r, "extra", 1) for r in rows], ROWS + ", row string, place int").repartition(5)
    found = covertree.hard_negatives(table, F.col("vec_id") % 10 == 0, shard_bytes=shard_bytes)
    usable = [r for r in rows if r[0] != 7900]  # longer than 2^31 in integers
    assert _sorted(found.collect()) == _sorted(brute.hard_negatives(usable, step=10))


def test_hot_label_and_equal_scores(spark):
    rnd = np.random.default_rng(4)
    rows = [(i, 0 if i % 3 else int(rnd.integers(0, 3)), rnd.integers(-2, 3, 4).astype(float).tolist()) for i in range(400)]
    found = covertree.hard_negatives(spark.createDataFrame(rows, ROWS), F.col("vec_id") % 20 == 0)
    assert _sorted(found.collect()) == _sorted(brute.hard_negatives(rows, step=20))


def test_tree_covers_and_separates():
    rnd = np.random.default_rng(5)
    x = np.floor(256 * np.concatenate([rnd.normal(size=(900, 3)), np.repeat(rnd.normal(size=(2, 3)), 100, axis=0)]))
    tree = covertree.CoverTree(np.arange(len(x)), np.zeros(len(x), int), np.arange(len(x)), x)
    assert sorted(tree.ids.tolist()) == list(range(len(x))) and (x[tree.ids] == tree.x).all()
    lifted = np.column_stack([tree.x, np.sqrt(np.maximum(0, tree.norm**2 - (tree.x**2).sum(axis=1)))])
    centre_of = {tuple(c): c for c in tree.centres}
    assert len(centre_of) > 10 and (tree.level[1:] != 0).any()

    def below(node):
        points = list(range(tree.points_from[node], tree.points_to[node]))
        for child in range(tree.child_from[node], tree.child_to[node]):
            points += below(child)
        return points

    for node in range(1, len(tree.level)):
        points = below(node)
        centre = next(p for p in points if (tree.x[p] == tree.centres[node]).all())
        off = np.linalg.norm(lifted[points] - lifted[centre], axis=1)
        assert off.max() <= covertree._BASE ** tree.level[node] + 1e-6
        assert off.max() <= 2 * tree.norm * np.sin(tree.angle[node] / 2) + 1e-6
        q = np.floor(256 * rnd.normal(size=3))
        scale = np.linalg.norm(q) * tree.norm
        at = np.arccos(np.clip(tree.centres[node] @ q / scale, -1, 1))
        scores = tree.x[points] @ q
        assert scores.max() <= scale * np.cos(max(0, at - tree.angle[node] - 1e-6)) + 1e-6
        assert scores.min() >= scale * np.cos(min(np.pi, at + tree.angle[node] + 1e-6)) - 1e-6
    for node in range(len(tree.level)):
        children = range(tree.child_from[node], tree.child_to[node])
        centres = [next(p for p in below(c) if (tree.x[p] == tree.centres[c]).all()) for c in children]
        for a in range(len(centres)):
            for b in range(a):
                apart = np.linalg.norm(lifted[centres[a]] - lifted[centres[b]])
                assert apart > covertree._BASE ** tree.level[children[a]] - 1e-6


def test_search_skips_nodes_outside_its_windows():
    rnd = np.random.default_rng(6)
    x = np.floor(256 * (np.repeat(rnd.normal(size=(60, 4)), 100, axis=0) + 0.01 * rnd.normal(size=(6000, 4))))
    tree = covertree.CoverTree(np.arange(6000), np.zeros(6000, int), np.arange(6000), x)
    verified, plain = [], tree._scores
    tree._scores = lambda points, q, exact: verified.append(points.stop - points.start) or plain(points, q, exact)
    best = covertree.Best(10)
    tree.search(x[5], 0, True, 5, [best])
    true = sorted(((-int(x[5] @ v), i) for i, v in enumerate(x) if i != 5))[:10]
    assert list(zip((-best.scores).tolist(), best.ids.tolist())) == true
    assert sum(verified) < 1500


# ---- vector codes -----------------------------------------------------------------
def test_nearest_by_sums():
    rnd = np.random.default_rng(1)
    for dim in (1, 3, 8):
        x, entries = rnd.integers(-5, 6, (2000, dim)), rnd.integers(-5, 6, (16, dim))
        entries[7] = entries[3]
        found, distance = vectorcode.nearest(x, entries)
        true = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (found == true.argmin(axis=1)).all() and (distance == true.min(axis=1)).all()


@pytest.mark.parametrize("few_labels", [0, 100])
@pytest.mark.parametrize("n, dim", [(300, 16), (5, 16), (60, 19)])
def test_vector_codes(spark, n, dim, few_labels):
    rnd = np.random.default_rng(n)
    rows = [(int(i), [None, 0, 1][int(rnd.integers(0, 3))], rnd.normal(size=dim).tolist()) for i in rnd.permutation(n)]
    rows += [(None, 1, rnd.normal(size=dim).tolist()), rows[0], rows[0]]
    odd = [(9000, 1, None), (9001, 1, [float("inf")] * dim), (9002, 2, [None] * dim)]
    table = spark.createDataFrame([(*r, "x", 5) for r in rows + odd], ROWS + ", code string, dim int").repartition(4)
    coded, _ = vectorcode.compress(table, few_labels=few_labels)
    got = coded.select("vec_id", F.lower(F.hex("codes")), "error", "label_error", "codebooks_sha256")
    assert _sorted(got.collect()) == _sorted(brute.vector_codes(rows))


def test_lengths_have_their_own_codebooks(spark):
    rnd = np.random.default_rng(8)
    rows = [(i, i % 2, rnd.normal(size=8 if i % 3 else 24).tolist()) for i in range(120)] + [(500, 1, [])]
    coded, books = vectorcode.compress(spark.createDataFrame(rows, ROWS))
    assert sorted(books) == [0, 8, 24]
    for dim in (8, 24):
        some = brute.vector_codes([r for r in rows if len(r[2]) == dim])
        got = coded.where(F.col("dim") == dim).select("vec_id", F.lower(F.hex("codes")), "error", "codebooks_sha256")
        assert _sorted(got.collect()) == _sorted((i, code, error, digest) for i, code, error, _, digest in some)
    restored = {r.vec_id: r for r in vectorcode.restore(coded, books).collect()}
    assert restored[500].restored == [] and bytes(restored[500].codes) == bytes(8)
    for i, _, v in rows[:30]:
        off = (np.floor(4096 * np.array(v)) - 4096 * np.array(restored[i].restored)) ** 2
        assert int(off.sum()) == restored[i].error


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], ROWS).write.parquet(f"{tmp_path}/embeddings.parquet")
    for name in ("op11_hard_negatives", "op12_speculative_bpe", "op13_vector_codes"):
        assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0, name
