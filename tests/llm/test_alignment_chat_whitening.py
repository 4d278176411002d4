"""Whitening, chat formatting and cross-tokenizer alignment against plain versions, and on odd inputs."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from roadflow.llm import alignment, chat, queries, whitening
from roadflow.llm.bpe import byte_symbols

SF = "/root/testdata/sf0.001"
PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# 11 whitening

def check_whitening(model, rows, vectors):
    """``rows``: (vec_id, whitened, deviation); ``vectors``: vec_id -> entries of those that stay."""
    grid = {i: np.floor(np.array(v, np.float64) * 64).astype(int) + 1_000_000 for i, v in vectors.items()}
    distinct = np.unique(np.array(list(grid.values())), axis=0)
    n, s = len(distinct), distinct.sum(axis=0)
    y = (distinct * n - s) / n
    cov = y.T @ y / n
    k = len(model.values)
    assert model.n == n and k == min(16, np.linalg.matrix_rank(y))
    assert np.abs(cov @ model.vectors - model.vectors * model.values).max() <= 1e-12 * np.abs(cov).max()
    assert np.abs(model.vectors.T @ model.vectors - np.eye(k)).max() < 1e-13
    assert np.allclose(model.values, np.linalg.eigvalsh(cov)[::-1][:k], rtol=1e-11)
    assert np.allclose(model.explained, model.values / np.trace(cov), rtol=1e-11)
    assert model.identity_error < 1e-9
    assert {i for i, _, _ in rows} == set(vectors)
    for i, whitened, deviation in rows:
        apart = [n * int(a) - int(b) for a, b in zip(grid[i], s)]
        assert deviation == sum(a * a for a in apart)
        assert np.allclose(whitened, np.array(apart) / n @ model.vectors / np.sqrt(model.values), rtol=1e-9, atol=1e-9)


def projected(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, whitened string, __x string")
    model = whitening.fit(df)
    out = whitening.transform(df.withColumnRenamed("whitened", "kept"), model)
    assert out.columns == ["vec_id", "embedding", "kept", "__x", "whitened", "deviation"]
    return model, [(r["vec_id"], r["whitened"], r["deviation"]) for r in out.collect()]


def test_whitening_equals_dense_eigenvectors(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    df = df.unionByName(df.filter("vec_id % 3 = 0").withColumn("vec_id", F.col("vec_id") + 10_000_000))  # copies count once
    model = whitening.fit(df)
    rows = [(r["vec_id"], r["whitened"], r["deviation"]) for r in whitening.transform(df, model).collect()]
    check_whitening(model, rows, {r["vec_id"]: r["embedding"] for r in df.collect()})


def test_whitening_drops_bad_vectors_and_keeps_the_rank(spark):
    rng = np.random.default_rng(5)
    low = rng.normal(size=(40, 3)) @ rng.integers(-2, 3, size=(3, 8)) // 1  # whole numbers: the grid keeps the rank
    good = {i: v.tolist() for i, v in enumerate(low)}
    bad = [(100, None), (101, []), (102, [1.0] * 7), (103, [None] + [1.0] * 7), (104, [float("nan")] * 8),
           (105, [float("inf")] + [0.0] * 7), (106, [3e38] + [0.0] * 7)]
    model, rows = projected(spark, [(i, v, "a", "b") for i, v in [*good.items(), *bad]])
    check_whitening(model, rows, good)


@pytest.mark.parametrize("vectors, n", [([], 0), ([None], 0), ([[1.0, 2.0]] * 3, 1)])
def test_whitening_without_variance_has_no_components(spark, vectors, n):
    model, rows = projected(spark, [(i, v, "a", "b") for i, v in enumerate(vectors)])
    assert model.n == n and len(model.values) == 0
    assert [list(w) for _, w, _ in rows] == [[] for v in vectors if v]


def test_deviation_beyond_a_long_is_null(spark):
    model, rows = projected(spark, [(0, [2.0 ** 39], "a", "b"), (1, [0.0], "a", "b")])
    assert [d for _, _, d in rows] == [None, None] and len(model.values) == 1


def test_jacobi_and_cholesky_on_graded_matrices():
    rng = np.random.default_rng(6)
    for d, rank in ((1, 1), (2, 1), (7, 7), (30, 12)):
        g = rng.normal(size=(d, rank)) * 10.0 ** rng.integers(-3, 4, size=rank)
        values, vectors = whitening.eigen(g @ g.T)
        assert np.abs(g @ g.T @ vectors - vectors * values).max() <= 1e-11 * values[0]
    met = {frozenset(p) for i, j in whitening.disjoint_pairs(7) for p in zip(i.tolist(), j.tolist())}
    assert len(met) == 21
    assert whitening.eigen(np.zeros((3, 3)))[0].size == 0


def test_whitening_query_columns(spark):
    out = queries.op11_whitening(spark, SF)
    assert dict(out.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
        "explained": "double", "identity_error": "double"}
    assert out.count() == 16 * spark.read.parquet(f"{SF}/embeddings.parquet").count()


# 12 chat

ODD = ["<", "|", "\\", "<|im_end|>", "\n", "a", "<\\|", "é𝒳", "<|im_start|>user\n", "n", "\\n", "\r"]


def odd_turns(rows, most=12, seed=1):
    rng = random.Random(seed)

    def text():
        return "".join(rng.choice(ODD) for _ in range(rng.randint(0, most)))

    return [(rng.choice([None, 1, 1, 1, 1, 2, 3]), rng.choice([None, *range(rows)]),
             rng.choice(["user", "assistant", "assistant", text(), None]), rng.choice([None, text(), text()]), "x")
            for _ in range(rows)]


TURNS = "conv_id long, turn long, role string, text string, segment string"


def test_chat_round_trip_over_split_conversations(spark):
    """One conversation holds over half of the rows and stands in many partitions."""
    rows = odd_turns(1500)
    rows += rows[:300]  # repeated rows are turns each
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        formatted = chat.segments(spark.createDataFrame(rows, TURNS).repartition(7))
        made = chat.examples(formatted)
        stored, example_rows = formatted.collect(), made.collect()
        got = {r["id"]: r for r in chat.read_back(formatted, made).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert set(got) == {1, 2, 3, None}
    for conversation, row in got.items():
        mine = sorted((s for s in stored if s["id"] == conversation), key=lambda s: s["position"])
        whole = "".join(s["segment"] for s in mine)
        assert [s["position"] for s in mine] == list(range(len(mine)))
        assert all(whole[s["start"]:s["end"]] == s["segment"] for s in mine)
        turns = [chat.read_turn(s["segment"]) for s in mine]
        key = [(-1 if t is None else t, r or "") for i, t, r, x, _ in rows if i == conversation]
        assert sorted(turns) == sorted((r or "", x or "") for i, _, r, x, _ in rows if i == conversation)
        assert [r for r, _ in turns] == [r for _, r in sorted(key)]
        replies = [x for r, x in turns if r == "assistant"]
        own = sorted((e for e in example_rows if e["id"] == conversation), key=lambda e: e["example"])
        assert [chat.unescaped(whole[e["loss_start"]:e["loss_end"]]) for e in own][:len(replies)] == replies
        assert own[-1]["chars"] == len(whole)
        assert (row["n_turns"], row["turns_sha256"]) == (len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)))
        assert (row["loss_chars"], row["loss_sha256"]) == (sum(map(len, replies)), sha("".join(replies)))
        assert row["formatted_chars"] == sum(e["chars"] for e in own)


def test_chat_examples_hold_all_turns_before_their_reply(spark):
    rows = [(5, 0, "system", "be <|im_end|>", ""), (5, 1, "user", None, ""), (5, 2, "assistant", "one", ""),
            (5, 3, "user", "b", ""), (5, 4, "assistant", "", ""), (5, 5, "user", "left over", ""), (6, 0, "user", "?", "")]
    formatted = chat.segments(spark.createDataFrame(rows, TURNS))
    made = chat.examples(formatted)
    out = {(r["id"], r["example"]): (r["text"], r["loss_start"], r["loss_end"])
           for r in chat.render(formatted, made).collect()}
    turn = {i: f"<|im_start|>{r}\n{(t or '').replace('<|', chr(60) + chr(92) + '|')}<|im_end|>\n"
            for i, (_, _, r, t, _) in enumerate(rows)}
    one, two = turn[0] + turn[1] + turn[2], turn[0] + turn[1] + turn[2] + turn[3] + turn[4]
    assert out[5, 0][0] == one and one[out[5, 0][1]:out[5, 0][2]] == "one"
    assert out[5, 1][0] == two and out[5, 1][1] == out[5, 1][2] == len(two) - len("<|im_end|>\n")
    assert out[5, 2] == (two + turn[5], len(two + turn[5]), len(two + turn[5]))
    assert out[6, 0] == (turn[6], len(turn[6]), len(turn[6])) and len(out) == 4


def test_chat_query_and_empty_table(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect()
    want = collections.defaultdict(list)
    for r in table:
        want[r["conv_id"]].append((r["role"], r["text"] or ""))
    want[-1] = [(r, "<|im_end|><|im_start|>assistant ok") for r in ("user", "assistant")]
    got = queries.op12_chat(spark, SF).collect()
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in got} == {
        i: (len(t), sha("".join(f"{a}\n{b}\n" for a, b in t)), sum(len(b) for a, b in t if a == "assistant"),
            sha("".join(b for a, b in t if a == "assistant"))) for i, t in want.items()}
    none = chat.segments(spark.createDataFrame([], TURNS))
    assert chat.read_back(none, chat.examples(none)).count() == 0


# 13 alignment

@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(PATH_A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATH_B)
    at = {s: i for i, s in enumerate(byte_symbols())}
    return (lambda t: a.encode(" " + t, add_special_tokens=False).ids, lambda i: bytes(at[c] for c in a.id_to_token(i)),
            b.encode, lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
            else b.id_to_piece(i).replace("▁", " ").encode())


def plain_groups(text, tokenizers):
    encode_a, bytes_a, encode_b, bytes_b = tokenizers
    if not text:
        return []
    a, b, whole = encode_a(text), encode_b(text), (" " + text).encode()
    if b"".join(map(bytes_a, a)) != whole or b"".join(map(bytes_b, b)) != whole:
        return []
    out, left, right, i, j, at_a, at_b = [], [], [], 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if at_a <= at_b:
            left.append(a[i])
            at_a += len(bytes_a(a[i]))
            i += 1
        else:
            right.append(b[j])
            at_b += len(bytes_b(b[j]))
            j += 1
        if at_a == at_b:
            out.append((left, right))
            left, right = [], []
    return out


def plain_alignment(docs, tokenizers):
    groups = [plain_groups(t, tokenizers) for t in docs]
    count = collections.Counter()
    for g in groups:
        count.update({(x, y) for a, b in g for x in a for y in b})
    best = collections.defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for g in groups:
        links = [(x, y) for a, b in g for x in a for y in b]
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(links),
                    sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), sha(shown) if g else ""))
    return out


RESULT = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
TEXTS = [None, "", " ", "  two  spaces ", "a▁b", "▁", "<|endoftext|> and <s> </s> <unk> <0x41>", "é𝒳ß\x00\x1c ", "同じ文字 です",
         "\n\n\tx", "x" * 3000, "ﬁ ① Å", " " * 60_000 + "x", "a b c " * 8000, "same text", "same text", "\r\n", "don't I'll"]


def noise(seed, n):
    rng = random.Random(seed)
    pieces = ["the ", "ing", " of", "é", "\n", "  ", "1", "2024", "!?", "汉字", "ß", "𝒳", "Ab", "'s", "\t", "<0x0A>", "ّ"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("block", [alignment.BLOCK, 1])
def test_alignment_equals_plain_version(spark, tokenizers, monkeypatch, block):
    """In one block, and in one for each shard of about 64 pairs."""
    if block == 1:
        monkeypatch.setattr(alignment, "SHARD", 256)
    texts = TEXTS + noise(7, 120)
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, a string, row string").repartition(3)
    got = alignment.align(docs, PATH_A, PATH_B, block=block).collect()
    assert [tuple(r[c] for c in RESULT) for r in sorted(got, key=lambda r: r["id"])] == plain_alignment(texts, tokenizers)


def test_alignment_query_equals_plain_version(spark, tokenizers):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = queries.op13_alignment(spark, SF).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in RESULT) for r in got] == plain_alignment([r["text"] for r in docs], tokenizers)


def test_links_of_long_groups_come_in_slices(monkeypatch):
    class Bytes:
        size, length = 100, np.array([*[1] * 99, 10_000])

    # 200 groups of one pair, one A token that meets 10,000 B tokens, and one pair more
    left = np.array([*range(20)] * 10 + [99, 5], np.int32)
    right = np.array([7] * 200 + [*range(40)] * 250 + [3], np.int32)
    whole = {}
    for most in (16, 1 << 20):
        monkeypatch.setattr(alignment, "LINKS", most)
        here = alignment.Aligned([left.tobytes(), b""], [right.tobytes(), b""], Bytes, Bytes)
        parts = list(here.links())
        whole[most] = collections.Counter(zip(*(np.concatenate(p).tolist() for p in zip(*parts))))
        assert max(len(d) for d, _ in parts) <= 2 * most
    assert whole[16] == whole[1 << 20]
    assert sum(whole[16].values()) == 200 + 10_000 + 1


def test_alignment_of_no_text(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(none, PATH_A, PATH_B).collect() == []
    got = alignment.align(spark.createDataFrame([("p", None), ("q", "")], "doc_id string, text string"), PATH_A, PATH_B)
    assert sorted(tuple(r) for r in got.select("id", *RESULT).collect()) == [
        ("p", 0, 0, 0, 0, 0, 0, ""), ("q", 0, 0, 0, 0, 0, 0, "")]


def test_perfect_hash_is_minimal_and_verified():
    rng = np.random.default_rng(8)
    keys = np.unique(rng.integers(0, 1 << 62, 50_000))
    shard = alignment.shard_of(keys, 5)
    rows = []
    for s in range(5):
        sizes, words = alignment.build_shard(keys[shard == s])
        own = keys[shard == s]
        place = alignment.PerfectHash(5, [(s, sizes, words.tobytes(), b"")]).place(own)
        ordered = np.empty(len(own), np.int64)
        ordered[place] = own
        rows.append((s, sizes, words.tobytes(), ordered.tobytes()))
    table = alignment.PerfectHash(5, rows)
    assert sorted(table.verified(keys).tolist()) == list(range(len(keys)))
    others = np.setdiff1d(rng.integers(0, 1 << 62, 10_000), keys)
    assert (table.verified(others) == -1).all()
    assert sum(len(w) for _, _, w, _ in rows) * 8 < 5 * len(keys)  # bits a key
