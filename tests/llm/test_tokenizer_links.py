import hashlib
from collections import Counter

import numpy as np
import pytest

from scholar_lake.llm import tokenizer_links


def walked(texts):
    """The contract, token by token."""
    (encode_a, bytes_a), (encode_b, bytes_b) = tokenizer_links.tokenizers(tokenizer_links.FOLDER)
    made, counts = [], Counter()
    for text in texts:
        a, b = (encode_a([" " + text])[0], encode_b([text])[0]) if text else ([], [])
        whole = b" " + (text or "").encode()
        if b"".join(bytes_a[i] for i in a) != whole or b"".join(bytes_b[i] for i in b) != whole:
            a, b = [], []
        ends_a, ends_b = np.cumsum([len(bytes_a[i]) for i in a]).tolist(), np.cumsum([len(bytes_b[i]) for i in b]).tolist()
        cuts, groups = sorted(set(ends_a) & set(ends_b)), []
        for low, high in zip([0, *cuts], cuts):
            groups.append("|".join(",".join(str(i) for i, e in zip(ids, ends) if low < e <= high) for ids, ends in ((a, ends_a), (b, ends_b))))
        links = [(x, y) for x, e in zip(a, ends_a) for y, f in zip(b, ends_b) if e == f]
        counts.update(links)
        made.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    most = Counter()
    for (x, y), n in counts.items():
        most[y] = max(most[y], n)
    return [(na, nb, ng, len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links), digest)
            for na, nb, ng, links, digest in made]


TEXTS = ["Hello world", "hello  world \n\n tabs\there", "été 日本語 🙂 naïve", "<|endoftext|> and <s> </s> <unk>", "▁already", "", None, "a", " ", "x" * 500,
         "\x00\x01 control", "don't can't I'll 12,345.678", "日本語" * 50, "Hello world", "\ufeffmark", "e\u0301 combined", "\u2028 line"]


def test_contract_token_by_token(spark, monkeypatch):
    for heavy in (4096, 3):
        monkeypatch.setattr(tokenizer_links, "HEAVY", heavy)
        docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
        rows = sorted(tokenizer_links.counted_links(docs).collect())
        assert [tuple(r)[1:] for r in rows] == walked(TEXTS)


def test_special_strings_are_plain_text():
    (encode, _), (pieces, _) = tokenizer_links.tokenizers(tokenizer_links.FOLDER)
    assert 50256 not in encode([" <|endoftext|>"])[0] and not {0, 1, 2} & set(pieces(["<s></s><unk>"])[0])


@pytest.mark.parametrize("seed", range(5))
def test_pointer_jumping_finds_components(seed):
    rng = np.random.default_rng(seed)
    size = 400
    a, b = (np.append(np.sort(rng.choice(np.arange(1, size), n, replace=False)), size) for n in (60, 90))
    last = tokenizer_links.last_tokens(a, b)
    shared = np.intersect1d(a, b)
    component = np.searchsorted(shared, np.concatenate((a, b)))
    assert np.array_equal(np.concatenate((a, b))[last], shared[component]) and (last >= len(a)).all()


def test_long_chain_takes_few_steps():
    a, b = np.arange(2, 200002, 2), np.append(np.arange(1, 200000, 2), 200000)  # all cuts differ but the last one
    assert (tokenizer_links.last_tokens(a, b) == len(a) + len(b) - 1).all()


def test_awkward_rows(spark, awkward, nothing):
    rows = tokenizer_links.counted_links(awkward).collect()
    assert len(rows) == awkward.count() and {r.n_a for r in rows if r.doc_id in (3, 4)} == {0}
    assert len({tuple(r) for r in rows if r.doc_id == 0}) == 1 and all(r.n_groups for r in rows if r.doc_id in (6, 7, 8, 9))
    assert tokenizer_links.counted_links(nothing).count() == 0


def test_both_encoders_agree():
    """The fast encoder and the file's own library, for every code point in several surroundings."""
    from tokenizers import Tokenizer
    made = Tokenizer.from_file(f"{tokenizer_links.FOLDER}/{tokenizer_links.BYTE_LEVEL}")
    made.encode_special_tokens = True
    texts = [f" a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}  {chr(c)}\n" for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts += [t for t in TEXTS if t] + ["ab " * 40000, "x" * 150000, " " * 150000]
    encode = tokenizer_links.tokenizers(tokenizer_links.FOLDER)[0][0]
    for i in range(0, len(texts), 50000):
        assert encode(texts[i:i + 50000]) == [e.ids for e in made.encode_batch(texts[i:i + 50000], add_special_tokens=False)]
