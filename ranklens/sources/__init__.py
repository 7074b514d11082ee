from ranklens.sources.text_formats import (  # noqa: F401
    labels_from_qrels,
    parse_ltr,
    qrels_as_prefs,
    qrels_lookup,
    read_corpus,
    read_ltr,
    read_prefs,
    read_qrels,
    read_qrels_jg,
    read_qrels_prefs,
    read_run,
    read_topics,
    read_zref,
)
