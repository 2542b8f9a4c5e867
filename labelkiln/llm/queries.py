"""Registered queries of the subpackage: one ``opN_<name>`` per operator, each
over its whole table with production parameters, and ``pipeline``.

``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame``; ``ORACLE`` holds
the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F

from labelkiln.llm import sql_text
from labelkiln.llm.common import table

QUERIES = {}
ORACLE: dict[str, str] = {"op2_substring_dedup": sql_text.OP2, "op4_mixing": sql_text.OP4, "op4_mixing_filled": sql_text.OP4, "op6_quality_rules": sql_text.OP6,
                          "op7_chat_format": sql_text.OP7, "op11_spelling_variants": sql_text.OP11, "op12_prefix_trie": sql_text.OP12,
                          "op13_embedding_near_dedup": sql_text.OP13}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_simhash_near_dedup(spark, sf_dir):
    """Fingerprint and component of every document (4-word shingles, 4 bits)."""
    from labelkiln.llm.simhash import hex_digits, near_duplicates
    near = near_duplicates(table(spark, sf_dir, "documents"))
    return near.select("doc_id", hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id")


@query
def op2_substring_dedup(spark, sf_dir):
    """Words of every document left after removing repeated 50-word windows."""
    from labelkiln.llm.substrings import remove_repeats
    left = remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op3_quality_resampling(spark, sf_dir):
    """Log weight, Gumbel draw and verdict of every document."""
    from labelkiln.llm.resampling import draw
    return draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_mixing(spark, sf_dir):
    """Words that the mix takes of every document, no fitting one left out."""
    from labelkiln.llm.mixing import mix_counts
    return mix_counts(table(spark, sf_dir, "documents"))


@query
def op4_mixing_filled(spark, sf_dir):
    """``op4_mixing`` under the name that its rule had before."""
    return op4_mixing(spark, sf_dir)


@query
def op5_nearest_neighbours(spark, sf_dir):
    """The 10 nearest vectors of every vector whose id is divisible by 100."""
    from labelkiln.llm.neighbours import nearest
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op6_quality_rules(spark, sf_dir):
    """Base counts and verdict of every document."""
    from labelkiln.llm.quality_rules import judge
    return judge(table(spark, sf_dir, "documents"))


@query
def op7_chat_format(spark, sf_dir):
    """Every conversation formatted, then read back from the output."""
    from labelkiln.llm.chat import fold, masked_text, read_back, render, rows_to_events
    tricky = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)],
                                "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    done = render(fold(rows_to_events(rows)))
    back = done.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"),
                       read_back(F.col("formatted")).alias("turns"),
                       masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       "formatted_chars")


@query
def op8_toxicity(spark, sf_dir):
    """Toxicity of every document; a quarter of the ids is held out of training."""
    from labelkiln.llm.toxicity import DECISION, score
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    scored = score(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"), ~out)
    return scored.select("doc_id", out.alias("held_out"), "score",
                         F.when(F.col("score") >= DECISION, 1).otherwise(0).cast("int").alias("predicted"))


@query
def op9_pii(spark, sf_dir):
    """Every document with its personal data replaced by pseudonyms."""
    from labelkiln.llm.pii import pseudonymize
    return pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"), corpus_pipeline.PII_KEY)


@query
def op10_bpe(spark, sf_dir):
    """Encode every document with the 49k word BPE file, then decode."""
    import public_tokenizers

    from labelkiln.llm.bpe import Bpe
    bpe = Bpe(spark, public_tokenizers.path("word_bpe_49k.json"))
    both = bpe.encode_decode(table(spark, sf_dir, "documents"), ["doc_id"])
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op11_spelling_variants(spark, sf_dir):
    """Every frequent word with its near words' number, its form and its root; one
    run in about 97 is given a typo first."""
    from labelkiln.llm.spelling import variant_groups, vocabulary
    words = vocabulary(table(spark, sf_dir, "documents"), typo_every=97)
    return variant_groups(words).select("word", "form", "root", "n", "n_near", "form_n")


@query
def op12_prefix_trie(spark, sf_dir):
    """Every node of the prefix trie of all conversations, each begun by up to five
    turns of the conversation that opens its hundred."""
    from labelkiln.llm.prefix_trie import graft, number_turns, prefix_trie
    conv = F.col("conv")
    return prefix_trie(*graft(number_turns(table(spark, sf_dir, "conversations")), donor=conv - conv % 100,
                              first=F.crc32(conv.cast("string")) % 6, most=5))


@query
def op13_embedding_near_dedup(spark, sf_dir):
    """Links and component of every vector among those of its label."""
    from labelkiln.llm.embedding_dedup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


@query
def pipeline(spark, sf_dir):
    """The stages of corpus_pipeline.py over all documents."""
    return corpus_pipeline.run(spark, sf_dir)
