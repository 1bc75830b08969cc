"""Review-text operators on a small Portuguese fixture, against a brute-force Python twin
(the driver's prose contains none of the target words, so the SQL check sees empty sets)."""

from collections import Counter

import regex

from shipcast.functions import text as tx
from shipcast.operators import review_text as rt

TEXTS = [
    "Não recebi o produto, o prazo já passou e nada!",
    "Produto veio quebrado; recebi com defeito. Prazo ok.",
    "recebi recebi rápido, veio bem embalado, dentro do prazo",
    "Comprei 2 unidades e veio só uma... péssimo atendimento da loja",
    "O prazo de entrega foi cumprido, mas o produto veio riscado",
    "nada a declarar",
    "Veio, VEIO, veio: produto diferente do anunciado; não recomendo esta loja",
]


def _brute(texts, targets, width, k):
    sw = set(tx.stop_words())
    out = []
    for w in targets:
        c = Counter()
        for s in texts:
            t = regex.findall(tx.RAW_TOKEN, s.lower())
            if w not in t:
                continue
            pos = t.index(w) + 1
            start, end = max(pos - width, 1), min(pos + width, len(t))
            c.update(x for x in t[start - 1:end] if len(x) >= tx.MIN_TOKEN_LENGTH and x not in sw)
        top = sorted(c.items(), key=lambda kv: (-kv[1], kv[0]))[:k]
        out += [(w, word, n) for word, n in top]
    return sorted(out)


def test_context_counts_match_brute_force(spark):
    bad = spark.createDataFrame([(s,) for s in TEXTS], "review_comment_message string").repartition(3)
    got = rt.top_context(rt.context_counts(bad), k=4).collect()
    assert sorted(tuple(r) for r in got) == _brute(TEXTS, rt.CONTEXT_TARGETS, rt.CONTEXT_WORDS, 4)
    assert got, "fixture must exercise the targets"
