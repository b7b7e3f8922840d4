"""The encoder looks a word up once for many texts, and encodes as the tokenizer does."""


class Counted(dict):
    asked = 0

    def get(self, key, default=None):
        self.asked += 1
        return super().get(key, default)


def test_each_distinct_word_is_looked_up_once():
    from carestrata.llm.queries import tokenizer_path
    from carestrata.llm.records import Encoder

    encoder = Encoder(tokenizer_path())
    encoder.known = Counted()
    texts = ["one two two, two", "two one\ntwo two", "two two one. (one)"] * 20
    assert encoder.encode(texts) == encoder.whole(texts)
    words = {w for t in texts for w in ("\n" + t).replace("\n", " \n").split(" ")[1:]}
    assert encoder.known.asked == len(words)


def test_any_white_space_and_edges_encode_as_the_whole_text():
    from carestrata.llm.queries import tokenizer_path
    from carestrata.llm.records import Encoder

    encoder = Encoder(tokenizer_path())
    spaces = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    texts = [f"a{s}b {s}c" for s in spaces] + [f"ab{s}cd" for s in spaces] + [f"{s}ab" for s in spaces] + [f"ab{s}" for s in spaces]
    texts += ["", "a", "\n", " ", "a.\n.b!?", "x <|endoftext|> y", "\u200b z\u200b", "é, ñ!\n¿q?", "..." * 30, "a\x00b c\x1f"]
    assert encoder.encode(texts) == encoder.whole(texts)
    assert encoder.encode(texts[::-1]) == encoder.whole(texts[::-1])
    assert encoder.encode([]) == []


def test_words_met_in_two_calls_are_found_without_the_dictionary():
    from carestrata.llm.queries import tokenizer_path
    from carestrata.llm.records import Encoder

    encoder = Encoder(tokenizer_path())
    texts = ["one two, two\nthree", "é, ñ!? (one)"]
    wanted = encoder.whole(texts)
    assert encoder.encode(texts) == wanted and encoder.encode(texts) == wanted
    encoder.known = Counted()
    assert encoder.encode(texts) == wanted
    assert encoder.known.asked == 0


def test_forgotten_words_are_encoded_alike(monkeypatch):
    from carestrata.llm import records
    from carestrata.llm.queries import tokenizer_path

    monkeypatch.setattr(records, "REMEMBERED_WORDS", 8)
    encoder = records.Encoder(tokenizer_path())
    for k in range(40):
        texts = [f"word{j}, word{j + 1}\nword{j}!. other{k % 3}" for j in range(k % 7, k % 7 + 5)] + ["  ", ""]
        assert encoder.encode(texts) == encoder.whole(texts)
        assert len(encoder.often) == len(encoder.often_ids) == len(encoder.met) == len(set(encoder.often.to_pylist()))
        assert len(encoder.often) <= 4 + len({w for t in texts for w in t.replace("\n", " \n").split(" ")}) * 2


def test_texts_are_grouped_by_count_and_bytes(monkeypatch):
    import pyarrow as pa

    from carestrata.llm import records

    monkeypatch.setattr(records, "TEXTS", 3)
    monkeypatch.setattr(records, "TEXT_BYTES", 10)
    assert records._groups(pa.array(["a"] * 7)) == [(0, 3), (3, 3), (6, 1)]
    assert records._groups(pa.array([None, "a" * 25, "b", "c" * 25])) == [(0, 1), (1, 2), (3, 1)]
    assert records._groups(pa.array([], pa.string())) == []
