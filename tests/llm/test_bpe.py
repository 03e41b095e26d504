import random

from tests.llm.helpers import CASES, cases, documents, small
from tokenizers import Tokenizer

from layerworks.llm import bpe
from layerworks.llm.queries import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")


def expected(pairs):
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    out = []
    for d, text in pairs:
        ids = t.encode(text or "", add_special_tokens=False).ids
        out.append((d, len(ids), " ".join(map(str, ids)), t.decode(ids, skip_special_tokens=False)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_tokens, r.ids, r.decoded) for r in df.collect()), key=str)


def test_equals_library_on_documents(spark):
    assert got(bpe.encode_documents(small(spark), PATH)) == expected(documents())


def test_equals_library_on_awkward_texts(spark):
    out = bpe.encode_documents(cases(spark), PATH)
    assert set(cases(spark).columns) < set(out.columns)
    assert got(out) == expected(CASES)


def test_long_texts_take_the_dealt_path_to_the_same_result(spark):
    assert got(bpe.encode_documents(cases(spark), PATH, long_text=0)) == expected(CASES)
    assert got(bpe.encode_documents(small(spark), PATH, long_text=500)) == expected(documents())


def test_unsplit_pieces_join_exactly(spark, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 64)
    t = bpe.WordTokenizer(PATH)
    for _, text in CASES:
        pieces = [(j, t.encode_piece(j, e, __import__("json").loads(w))) for j, e, w in t.pieces(text or "")]
        assert t.rejoin(pieces) == t.encode(text or "")[0]


def test_tree_concatenation_equals_one_merge():
    m = bpe.tokenizer(PATH).merges
    rng = random.Random(5)
    for alphabet in ("ab", "theanious", "aaab", "x1!"):
        for _ in range(60):
            s = m.symbols("".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 300))))
            whole = m.merge(s)
            size = rng.randrange(1, 40)
            assert m.concatenate([m.merge(s[i : i + size]) for i in range(0, len(s), size)]) == whole
            assert m._merge_by_heap(s) == whole


def test_empty_table(spark):
    assert bpe.encode_documents(cases(spark).limit(0), PATH).count() == 0


def test_equals_library_on_any_mix_of_common_characters():
    rng = random.Random(4)
    chars = [*map(chr, [*range(1, 384)]), " ", " ", "'s", "'RE", "a", "The", "<|endoftext|>", "<|STARTOFTEXT|>"]
    pairs = [(i, "".join(rng.choices(chars, k=60))) for i in range(400)]
    t = bpe.tokenizer(PATH)
    want = {d: (ids, text) for d, _, ids, text in expected(pairs)}
    for d, text in pairs:
        assert t.encode(text) == want[d]
