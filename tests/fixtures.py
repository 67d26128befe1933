"""Shared test inputs."""

# ---------------------------------------------------------------------------
# The reference's sample corpus (4 lines per language, in
# order es, en, fr) and the golden values computed on it.
SAMPLE_LINES = {
    "es": [
        "Me gusta aprender inteligencia artificial porque me ayuda a resolver problemas reales.",
        "La tokenización es un paso importante en el procesamiento de lenguaje natural.",
        "Estoy construyendo un proyecto en PyTorch para comparar tokenizadores.",
        "¿Cómo manejamos palabras con acentos como análisis, canción y programación?",
    ],
    "en": [
        "I enjoy learning artificial intelligence because it helps me solve real problems.",
        "Tokenization is an important step in natural language processing.",
        "I am building a PyTorch project to compare tokenizers.",
        "How do we handle punctuation, apostrophes, and multilingual text?",
    ],
    "fr": [
        "J'aime apprendre l'intelligence artificielle parce qu'elle m'aide à résoudre des problèmes réels.",
        "La tokenisation est une étape importante du traitement du langage naturel.",
        "Je construis un projet PyTorch pour comparer des tokeniseurs.",
        "Comment gérer les apostrophes, les accents et les mots composés ?",
    ],
}
SUMMARY_GOLDEN = {
    ("es", "char"): (4, 77.25, 70, 86, 37), ("es", "word"): (4, 10.75, 9, 12, 41),
    ("es", "edgegram"): (4, 18.5, 16, 21, 63), ("en", "char"): (4, 66.25, 54, 81, 33),
    ("en", "word"): (4, 9.75, 9, 12, 38), ("en", "edgegram"): (4, 16.5, 14, 21, 60),
    ("fr", "char"): (4, 74.25, 61, 97, 35), ("fr", "word"): (4, 10.75, 9, 12, 39),
    ("fr", "edgegram"): (4, 19.5, 16, 23, 60),
}
SPANISH_BATCH = [
    [2, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 3],
    [2, 16, 17, 18, 19, 20, 21, 22, 23, 24, 25, 26, 27, 3],
    [2, 28, 29, 19, 30, 22, 31, 32, 33, 34, 3, 0, 0, 0],
    [2, 35, 36, 37, 38, 39, 40, 41, 42, 43, 44, 3, 0, 0],
]
HOSTILE = ["", "   ", "a b c\x1cd\x85e", "l\u2019ami\u00a0: oui\u202f! x\u3000y", "x\u200by \ufeffz",
           "\U0001F600x \u00e9", "\u0130STANBUL \u039f\u0394\u039f\u03a3 stra\u00dfe"]
# ---------------------------------------------------------------------------


def sample_corpus_df(spark):
    rows = []
    for li, (lang, lines) in enumerate(SAMPLE_LINES.items()):
        for i, t in enumerate(lines):
            rows.append(((li << 40) + i, (li << 40) + i, lang, t))
    return spark.createDataFrame(rows, "doc_id bigint, doc_ord bigint, lang string, text string")


def texts_df(spark, texts):
    return spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)],
                                 "doc_id bigint, doc_ord bigint, text string")
