"""New words of any alphabet are encoded as one text, and lines are cut like words."""

import public_tokenizers
import pyarrow as pa

from goldweave.llm import chunks

TEXTS = ["größe naïve señor\nÜbermaß, ciónñ\nplain.\nWords 你好 мир", "İstanbul e\u0301te ΑΣ. ΑΣ\n\nÅngström"]


def test_words_of_any_alphabet_are_encoded_at_once():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = chunks.library_encoder.__wrapped__(path)
    alone, encode = [], encoder.encode
    encoder.encode = lambda group: (alone.extend(group), encode(group))[1]
    ids, counts = encoder.ids(pa.array(TEXTS))
    library = Tokenizer.from_file(path)
    want = [library.encode(t, add_special_tokens=False).ids for t in TEXTS]
    assert ids.tolist() == sum(want, []) and counts.tolist() == [len(w) for w in want]
    assert not {"größe", "naïve", "señor", "Übermaß", "ciónñ", "你好", "мир", "plain"} & set(alone)
    assert not any("\n" in w for w in encoder.slot)
