import hashlib
import random
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
import sentencepiece
from helpers import awkward, got, prose, table
from tokenizers import Tokenizer

from corpusml.llm import alignment

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def plain():
    first = Tokenizer.from_file(f"{alignment.FOLDER}/{alignment.FIRST}")
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=f"{alignment.FOLDER}/{alignment.SECOND}")


@pytest.fixture(scope="module")
def tokenizers():
    return alignment.Tokenizers(*((Path(alignment.FOLDER) / n).read_bytes() for n in (alignment.FIRST, alignment.SECOND)))


def brute(rows, plain):
    """The contract, by sets of byte offsets and loops over all pairs."""
    first, second = plain
    letters = alignment.byte_letters()
    done, docs_of = [], Counter()
    for row in rows:
        text, links, groups = row[1], Counter(), []
        a = first.encode(" " + text, add_special_tokens=False) if text else None
        if text:
            bytes_a = [bytes(letters[c] for c in t) for t in a.tokens]
            b = second.encode(text)
            pieces = [second.id_to_piece(i) for i in b]
            bytes_b = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
            if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                a = None
        if a:
            ends = []
            for parts in (bytes_a, bytes_b):
                ends.append([sum(map(len, parts[: k + 1])) for k in range(len(parts))] if len(parts) < 500 else np.cumsum([len(p) for p in parts]).tolist())
            common = sorted(set(ends[0]) & set(ends[1]))
            where = {e: k for k, e in enumerate(common)}
            members = defaultdict(lambda: ([], []))
            for side, ids in ((0, a.ids), (1, b)):
                g = 0
                for i, e in zip(ids, ends[side]):
                    members[g][side].append(i)
                    g += e in where
            groups = [members[g] for g in range(len(common))]
            for one, two in groups:
                for x, n in Counter(one).items():
                    for y, m in Counter(two).items():
                        links[x, y] += n * m
        docs_of.update(set(links))
        done.append((row[0], len(a.ids) if a else 0, len(b) if a else 0, groups, links))
    top = defaultdict(int)
    for (x, _), n in docs_of.items():
        top[x] = max(top[x], n)
    out = []
    for doc_id, n_a, n_b, groups, links in done:
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        best = sum(n for (x, y), n in links.items() if docs_of[x, y] == top[x])
        out.append((doc_id, n_a, n_b, len(groups), sum(links.values()), best, sum(n * docs_of[p] for p, n in links.items()),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


def test_against_brute_force(spark, plain):
    rows = awkward() + [
        (20, "<|endoftext|> <s> </s> <unk> <0x41>", "en", "a", 1), (21, "a ▁ b", "en", "a", 1), (22, "▁", "en", "a", 1), (23, " ", "en", "a", 1),
        (24, "日本語 テキスト。 그리고 😀😀 　x  y​ z", "en", "a", 1), (25, "a" * 3000 + " " + "é" * 700 + "\n\n\n   \t" + "-" * 1000, "en", "a", 1),
        (26, "\x00\x01 \x1c x\x85 y\r\n", "en", "a", 1), (27, "  two  leading   and trailing  ", "en", "a", 1), (28, "don't we'll 12345678 ,,,... (x)", "en", "a", 1),
    ]
    rng = random.Random(5)
    for k in range(30):
        rows.append((100 + k, "".join(rng.choice(["a", "the ", " ", "\n", "é", "日", " ", "😀", "'s", "1", "-", " token", "ization", "▁" if k % 7 == 0 else "x"]) for _ in range(200)), "en", "a", 1))
    wanted = brute(rows, plain)
    assert sum(w[1] == 0 for w in wanted) >= 4
    for block in (1, 2000, 4 << 20):
        result = alignment.align(table(spark, rows), block_bytes=block)
        assert result.columns == COLUMNS
        assert got(result, *COLUMNS) == sorted(wanted, key=lambda r: tuple((x is not None, str(x).zfill(9)) for x in r))


def test_empty_table(spark):
    assert alignment.align(table(spark, [])).collect() == []
    assert got(alignment.align(table(spark, [(1, None, None, None, None)])), *COLUMNS) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_runs_of_every_length(tokenizers):
    # Ends with stretches of equal places of 1 to 70, apart from each other by groups of 2 to 1 and 1 to 3.
    a, b, at = [], [], 0
    for n in [*range(1, 71), 3, 200, 1, 1, 40]:
        for _ in range(n):
            at += 2
            a.append(at)
            b.append(at)
        a += [at + 3, at + 9]
        b += [at + 4, at + 5, at + 9]
        at += 9
    a, b = np.array(a), np.array(b)
    for segment in ([len(a)], [0, len(a)]):
        cut_a, cut_b = alignment.groups(a, b, np.array(segment), np.array([len(b) if s else 0 for s in segment]))
        assert np.array_equal(a[cut_a - 1], np.intersect1d(a, b)) and np.array_equal(b[cut_b - 1], np.intersect1d(a, b))


def test_wide_groups_are_counted_by_ids(monkeypatch):
    a, b = np.array([7, 7, 8, 9]), np.array([1, 2, 1, 1, 5])
    cuts = np.array([3, 4]), np.array([4, 5])
    plain = Counter()
    keys, times, group = alignment.links(a, b, *cuts)
    for k, t in zip(keys.tolist(), times.tolist()):
        plain[k] += t
    monkeypatch.setattr(alignment, "WIDE_GROUP", 2)
    keys, times, group = alignment.links(a, b, *cuts)
    wide = dict(zip(keys.tolist(), times.tolist()))
    assert wide == plain == {7 << 32 | 1: 6, 7 << 32 | 2: 2, 8 << 32 | 1: 3, 8 << 32 | 2: 1, 9 << 32 | 5: 1}
    assert sorted(group.tolist()) == [0, 0, 0, 0, 1]


def test_ids_are_those_of_whole_texts(tokenizers, plain):
    first, second = plain
    texts = [prose(k, 300) + "\n" + "Zeile, eins.   und　zwei  drei" * k for k in range(1, 8)] + ["x" * 5000, "日本 " * 300]
    a, b, end_a, end_b, ok = alignment.encode_texts([t.encode() for t in texts], tokenizers, chunk=256)
    assert ok.all()
    for k, text in enumerate(texts):
        assert a[end_a[k - 1] if k else 0 : end_a[k]].tolist() == first.encode(" " + text, add_special_tokens=False).ids
        assert b[end_b[k - 1] if k else 0 : end_b[k]].tolist() == second.encode(text)


def test_every_character_is_cut_alike(tokenizers, plain):
    first, _ = plain
    for c in [*range(0x3100), *range(0xA000, 0xA500), 0xAC00, 0xFEFF, 0xFFFD, 0x1F600, 0xE0001]:
        text = f" a{chr(c)}b {chr(c)}1{chr(c)}, {chr(c)}  {chr(c)}'s"
        assert tokenizers.first.encode_ordinary(text) == first.encode(text, add_special_tokens=False).ids


def test_a_worker_forgets(spark, plain, monkeypatch, tokenizers):
    monkeypatch.setattr(alignment, "MEMORY", 100)
    texts = [prose(k, 50).encode() for k in range(6)]
    apart = [alignment.encode_texts([t], tokenizers) for t in texts]
    for side in (0, 1):
        assert np.array_equal(np.concatenate([x[side] for x in apart]), alignment.encode_texts(texts, tokenizers)[side])
