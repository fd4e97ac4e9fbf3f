import hashlib
import os
import random
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from returnsmith.llm import token_links
from returnsmith.llm.queries import op11_token_links
from tests.llm.cases import frame, messy

A_FILE, B_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute(rows):
    a, b = Tokenizer.from_file(A_FILE), sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    a.encode_special_tokens = True
    letters = token_links.byte_letters()
    docs = []
    for doc_id, text in rows:
        want = (" " + (text or "")).encode()
        x = a.encode(" " + (text or ""), add_special_tokens=False)
        at = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in x.ids]
        bt = [(i, bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
              for i in b.encode(text or "")]
        if not text or b"".join(t for _, t in at) != want or b"".join(t for _, t in bt) != want:
            at, bt = [], []
        docs.append((doc_id, at, bt))
    out, links = [], []
    for doc_id, at, bt in docs:
        of = [[j for j, (_, t) in enumerate(side) for _ in t] for side in (at, bt)]  # the token that covers each byte
        met = sorted(set(zip(*of, strict=True)))
        links.append([(at[x][0], bt[y][0]) for x, y in met])
        parts, shared = [([], [])], 0
        for k, (x, y) in enumerate(zip(*of, strict=True)):
            ends = [k + 1 == len(of[0]) or side[k + 1] != side[k] for side in of]
            for i, (side, j) in enumerate(((at, x), (bt, y))):
                if ends[i]:
                    parts[-1][i].append(side[j][0])
            if all(ends):
                parts.append(([], []))
        parts.pop()
        shared = sum(len(x) * len(y) for x, y in parts)
        text = ["|".join(",".join(map(str, side)) for side in g) for g in parts]
        sha = hashlib.sha256(";".join(text).encode()).hexdigest() if text else ""
        out.append([doc_id, len(at), len(bt), len(parts), len(met), shared, sha])
    count = Counter(p for own in links for p in own)
    best = Counter()
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    return sorted(((*r[:6], sum(count[p] == best[p[1]] for p in own), sum(count[p] for p in own), r[6])
                   for r, own in zip(out, links, strict=True)), key=str)


def test_alignment_equals_brute_force(spark):
    rng = random.Random(5)
    letters = "ab é漢😀\n\t ,.1<▁\x00ﬁñ"
    rows = [r[:2] for r in messy()] + [(90 + i, "".join(rng.choice(letters) for _ in range(80))) for i in range(30)]
    rows += [(200, "▁ lost"), (201, "<|endoftext|> <s> <0x41> <unk>"), (202, "word " * 9000), (203, "x" * 20000), (204, " lead  and trail ")]
    want = brute(rows)
    for pattern in (None, public_tokenizers.PATTERN):
        aligned = token_links.align(frame(spark, rows), A_FILE, B_FILE, pattern)
        assert sorted((tuple(r) for r in token_links.digests(aligned).collect()), key=str) == want
    assert token_links.digests(token_links.align(frame(spark, []), A_FILE, B_FILE)).count() == 0


def test_chunks_share_counts(spark, monkeypatch):
    """The same answers, whatever the size of a chunk and the number of tasks."""
    rows = [(i, f"alpha beta {i % 7} gamma delta") for i in range(300)]
    monkeypatch.setattr(token_links, "CHUNK_DOCS", 11)
    docs = frame(spark, rows).repartition(5).withColumn("n_a", F.lit("clash")).withColumn("chunk", F.lit(1))
    got = sorted((tuple(r) for r in token_links.digests(token_links.align(docs, A_FILE, B_FILE)).collect()), key=str)
    assert got == brute(rows)


def test_both_encoders_of_a_agree_on_every_letter():
    """A text's ids by the vocabulary file's own library and by the faster one, with every code point in several surroundings."""
    texts = ["".join(" a%sa1%s1.%s. %s  %s\n%s" % ((chr(c),) * 6) for c in range(low, min(low + 64, 0x110000)) if not 0xD800 <= c < 0xE000)
             for low in range(1, 0x110000, 64)]
    texts = [t for t in texts if t][::1 if os.environ.get("ORACLE_ALL") else 8]
    token_links._tokenizers.cache_clear()
    slow, fast = (token_links._tokenizers(A_FILE, B_FILE, p)[0] for p in (None, public_tokenizers.PATTERN))
    for low in range(0, len(texts), 1000):
        for x, y in zip(slow(texts[low:low + 1000]), fast(texts[low:low + 1000]), strict=True):
            assert x.tolist() == y.tolist()


def test_pairs_of_wide_ids():
    rng = np.random.default_rng(2)
    row, a, b = np.sort(rng.integers(0, 5, 300)), rng.integers(0, 4, 300), rng.integers(0, 4, 300)
    small = token_links._pairs(row, a, b)
    wide = token_links._pairs(row, a + (1 << 30) - 4, b + (1 << 31) - 4)  # too wide for one key
    assert small[0].tolist() == wide[0].tolist() and small[2].tolist() == wide[2].tolist()


def test_products_of_sparse_rows():
    rng = np.random.default_rng(3)
    for _ in range(20):
        x, y = rng.integers(0, 3, (7, 9)), rng.integers(0, 3, (9, 5))

        def csr(m):
            r, c = np.nonzero(m)
            return token_links.Csr(np.searchsorted(r, np.arange(len(m) + 1)), c, m[r, c], m.shape[1])

        z = token_links.multiply(csr(x), csr(y))
        dense = np.zeros((7, 5), int)
        dense[np.repeat(np.arange(7), np.diff(z.start)), z.column] = z.value
        assert (dense == x @ y).all()


def test_links_know_shared_bytes_and_groups():
    a, b = np.array([2, 5, 6, 9]), np.array([1, 5, 7, 9])
    overlap = token_links.overlap_links(a, b)
    assert overlap.value.tolist() == [1, 1, 3, 1, 1, 2] and overlap.value.sum() == 9
    pairs = [(i, c) for m in token_links.shared_group_links(np.array([0, 2, 4]), np.array([0, 2, 4]))
             for i in range(len(m.start) - 1) for c in m.column[m.start[i]:m.start[i + 1]].tolist()]
    assert pairs == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 2), (2, 3), (3, 2), (3, 3)]


def test_query_counts_every_document(spark):
    out = op11_token_links(spark, "/root/testdata/sf0.001")
    assert out.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert out.columns[:9] == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_group_links"]
