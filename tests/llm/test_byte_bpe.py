import random

import pytest
import public_tokenizers
from decantry.llm import byte_bpe as B
from decantry.llm.queries import BPE_JSON, BPE_RANKS, vocabulary
from helpers import corpus, docs

PIECES = [
    "a", "b", "the", " ", "  ", "\n", "\t", "é", "漢", "😀", "'s", "'", "1", "２", "!", "_", " ", "\xa0",
    "\x00", "\x1c", "\x85", "ing", "tion", "ß", "İ", "�", "‍", "\r\n", "ǅ", "²", "ां",
]


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken

    ranks = B.read_ranks(vocabulary(BPE_RANKS))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_ids_are_those_of_tiktoken(tiktoken_encoding):
    encode = B.Encoder(vocabulary(BPE_RANKS), public_tokenizers.PATTERN, True)
    for text in [*texts(1500), "x" * 20_000, "<|endoftext|>", " a", "a ", "\n", "a\n\nb  c"]:
        (ids,), (starts,) = encode([text])
        assert ids.tolist() == tiktoken_encoding.encode_ordinary(text)
        raw = [tiktoken_encoding.decode_single_token_bytes(i) for i in ids.tolist()]
        at, want = 0, []
        for token in raw:
            begun = text.encode()[:at]
            want.append(len(begun.decode(errors="ignore")))
            at += len(token)
        assert starts.tolist() == want  # a part of a character begins where that begins


def test_ids_of_the_library_file_whatever_the_batch():
    encode = B.Encoder(vocabulary(BPE_JSON), None, False)
    all_texts = texts(400, 5)
    together, none = encode(all_texts)
    assert none == []
    for text, ids in zip(all_texts, together, strict=True):
        want = encode.tokenizer.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want == encode([text])[0][0].tolist()


class Watched:
    """The library's tokenizer, and the texts that it is given to cut."""

    def __init__(self, tokenizer):
        self.tokenizer, self.cut = tokenizer, []

    def __getattr__(self, name):
        return getattr(self.tokenizer, name)

    def encode_batch_fast(self, texts, **options):
        self.cut += texts
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_words_go_to_the_model_without_being_cut():
    encode = B.Encoder(vocabulary(BPE_JSON), None, False)
    encode.tokenizer = watched = Watched(encode.tokenizer)
    rng = random.Random(8)
    words = ["one", "über", "漢字", "Ñandú", "ǅ", "don't", "x's.", "a_b", "'tis", "v2", "²", "ां", "é́a"]
    ends = ["", "", ",", ".", "'", "'s", "###", "_", "?!", "…", "&&&"]
    text = "first " + " ".join(rng.choice(words) + rng.choice(ends) for _ in range(3000)) + " \n\nend"
    got = encode([text])[0][0].tolist()
    assert got == watched.encode(text, add_special_tokens=False).ids
    assert " don't" in watched.cut and " v2" in watched.cut
    assert not {" one", " über,", " 漢字###", " Ñandú'", " ǅ_", " a"} & set(watched.cut)


def test_letters_are_those_that_the_library_keeps_together():
    cut = B.Encoder(vocabulary(BPE_JSON), None, False).tokenizer.pre_tokenizer.pre_tokenize_str
    letters = [c for c in map(chr, range(0x110000)) if c.isalpha()]
    assert len(cut("".join(letters))) == 1
    assert all(len(cut("a" + c)) == 2 for c in B.string.punctuation)
    assert len(cut(B.string.punctuation)) == 1


def test_a_tokenizer_that_changes_or_cuts_words_gets_them_all(tmp_path):
    from tokenizers import AddedToken, Tokenizer, normalizers, pre_tokenizers

    def lower(t):
        t.normalizer = normalizers.Lowercase()

    def cut_more(t):
        t.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Punctuation(), t.pre_tokenizer])

    def added(t):
        t.add_tokens([AddedToken("tok", normalized=False)])

    for change in (lower, cut_more, added):
        own = Tokenizer.from_file(vocabulary(BPE_JSON))
        change(own)
        own.save(str(tmp_path / change.__name__))
        encode = B.Encoder(str(tmp_path / change.__name__), None, False)
        text = "Some token, Words!? and more###"
        assert encode([text])[0][0].tolist() == encode.tokenizer.encode(text, add_special_tokens=False).ids


def test_kept_parts_are_bounded(monkeypatch):
    monkeypatch.setattr(B, "KEPT_PARTS", 50)
    encode = B.Encoder(vocabulary(BPE_JSON), None, True)
    for k in range(30):
        text = " ".join(f"w{k}x{i}" for i in range(20))
        (ids,), _ = encode([text])
        assert ids.tolist() == encode.tokenizer.encode(text, add_special_tokens=False).ids
    assert len(encode.ids) < 100


@pytest.mark.parametrize("ranked", [True, False])
def test_round_trip(spark, ranked):
    rows = corpus(2) + [(None, "é漢😀 <|endoftext|>", "a"), (7, "again", "a"), (7, "again", "a")]
    path = vocabulary(BPE_RANKS if ranked else BPE_JSON)
    pattern = public_tokenizers.PATTERN if ranked else None
    table = docs(spark, rows, clashing=True)
    back = B.decode(B.encode(table, path, pattern), path, ranked)
    got = [(r.doc_id, bytes(r.bytes), r.decoded) for r in back.collect()]
    want = [(r[0], (r[1] or "").encode(), r[1] or "") for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert B.encode(table.limit(0), path, pattern).count() == 0


def test_ids_that_split_a_character(spark):
    path = vocabulary(BPE_RANKS)
    ids = B.Encoder(path, public_tokenizers.PATTERN, True)(["😀"])[0][0].tolist()
    assert len(ids) > 1
    frame = spark.createDataFrame([(1, ids[:1]), (2, ids[1:]), (3, None), (4, [])], "k int, ids array<int>")
    rows = {r.k: r for r in B.decode(frame, path, ranked=True).collect()}
    assert bytes(rows[1].bytes) + bytes(rows[2].bytes) == "😀".encode()
    assert "�" in rows[1].decoded and bytes(rows[3].bytes) == bytes(rows[4].bytes) == b""


def test_byte_characters_are_256_different_printable_ones():
    chars = B.byte_characters()
    assert len(set(chars)) == 256 and all(c.isprintable() for c in chars)
    assert all(B.token_bytes(c) == bytes([b]) for b, c in enumerate(chars))
