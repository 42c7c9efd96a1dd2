"""Collocations from yearly bigram counts, as PySpark DataFrame functions."""

from pairlore.functions.measures import npmi, pmi
from pairlore.functions.words import (
    default_stop_words,
    is_stop_word,
    stop_text,
    without_listed_words,
)
from pairlore.operators.counts import (
    accepted_bigrams,
    count_pairs,
    decade_totals,
    first_word_counts,
    multi_level_counts,
    pair_counts,
    second_word_counts,
    two_word_ngrams,
)
from pairlore.operators.scores import (
    by_descending_score,
    by_second_word,
    by_words_nulls_first,
    in_fact_order,
    contingency,
    integrity_audit,
    npmi_scores,
    npmi_sums,
    passing_scores,
)
from pairlore.plans.pipeline import (
    collocations,
    collocations_from,
    read_stages,
    write_stages,
)
from pairlore.sources.facts import (
    as_facts,
    count_facts,
    pivot_counts,
    read_count_facts,
    read_score_facts,
    read_tagged_facts,
    rejected_facts,
    union_facts,
    write_facts,
)
from pairlore.sources.ngrams import (
    bigrams_of_text,
    ngrams_from_text,
    parse_ngram_lines,
    read_lines,
    read_ngrams,
    rejected_ngram_lines,
    write_sequence_file,
)
from pairlore.sources.sinks import write_by_decade, write_text

__all__ = [
    "accepted_bigrams",
    "as_facts",
    "bigrams_of_text",
    "by_descending_score",
    "by_second_word",
    "by_words_nulls_first",
    "in_fact_order",
    "collocations",
    "collocations_from",
    "contingency",
    "count_facts",
    "count_pairs",
    "decade_totals",
    "default_stop_words",
    "first_word_counts",
    "integrity_audit",
    "is_stop_word",
    "multi_level_counts",
    "ngrams_from_text",
    "npmi",
    "npmi_scores",
    "npmi_sums",
    "pair_counts",
    "parse_ngram_lines",
    "passing_scores",
    "pivot_counts",
    "pmi",
    "read_count_facts",
    "read_lines",
    "read_ngrams",
    "read_score_facts",
    "read_tagged_facts",
    "read_stages",
    "rejected_facts",
    "rejected_ngram_lines",
    "second_word_counts",
    "stop_text",
    "two_word_ngrams",
    "union_facts",
    "without_listed_words",
    "write_by_decade",
    "write_facts",
    "write_sequence_file",
    "write_stages",
    "write_text",
]
