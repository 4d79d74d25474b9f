"""The registered training-data queries: thin calls of the operators on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import (alignment, html_paths, kneser_ney, lattice, line_dedup, mixing, packing, prefix_trie, quality_rules,
               quotes, radix, secret_scan, simhash)
from .common import read


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_subword_lattice(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    s = lattice.score(docs, ~held_out, vocabulary("piece_bpe_32k.model"))
    return s.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                    "base_score", "score", "word_score")


def op2_hilbert_packing(spark, sf_dir):
    return packing.pack_documents(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), with_ids=False,
                                  remember=400_000)


def op3_quote_threads(spark, sf_dir):
    return quotes.reply_threads(read(spark, sf_dir, "conversations"))


def op4_rule_ledger(spark, sf_dir):
    led = quality_rules.ledger(read(spark, sf_dir, "documents"))
    led = quality_rules.apply_policy(led, quality_rules.POLICIES[quality_rules.CURRENT])
    failed = F.col("bits").bitwiseAND(F.lit(quality_rules.mask(quality_rules.BASE_RULES))) != 0
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "bits",
                      failed.alias("base_failed"), "kept")


def rule_ablations(spark, sf_dir):
    return quality_rules.ablations(quality_rules.ledger(read(spark, sf_dir, "documents")))


def op5_host_paths(spark, sf_dir):
    return html_paths.extract(read(spark, sf_dir, "pages"))


def op6_secret_ownership(spark, sf_dir):
    return secret_scan.report(read(spark, sf_dir, "documents"))


def op7_radix_dedup(spark, sf_dir):
    groups = radix.with_kept(radix.radix_groups(read(spark, sf_dir, "documents")))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_source_mix(spark, sf_dir):
    return mixing.plan_mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_kneser_ney(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    out, log_ppl, limit, kept = kneser_ney.classify(docs, read(spark, sf_dir, "labels"), F.col("quality") == 1,
                                                    carry=["doc_id", "lang"])
    return out.select("doc_id", "lang", "n_symbols", F.pow(F.lit(10.0), log_ppl).alias("perplexity"),
                      F.pow(F.lit(10.0), limit).alias("threshold"),
                      F.pow(F.lit(10.0), "log_passage").alias("passage_perplexity"),
                      F.pow(F.lit(10.0), "passage_limit").alias("passage_threshold"), F.col(kept).alias("kept"))


def op10_simhash_vp(spark, sf_dir):
    g = simhash.near_groups(read(spark, sf_dir, "documents"))
    return g.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_line_dedup(spark, sf_dir):
    docs, n_lines, n_dropped = line_dedup.drop_common_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", n_lines, n_dropped, F.sha2("text", 256).alias("kept_sha256"))


def op12_token_alignment(spark, sf_dir):
    return alignment.align(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"),
                           vocabulary("piece_bpe_32k.model"))


def op13_prefix_trie(spark, sf_dir):
    turns = prefix_trie.ordered_turns(read(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.with_shared_heads(turns, prefix_trie.heads_by_crc()))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def llm_queries():
    ops = (op1_subword_lattice, op2_hilbert_packing, op3_quote_threads, op4_rule_ledger, op5_host_paths,
           op6_secret_ownership, op7_radix_dedup, op8_source_mix, op9_kneser_ney, op10_simhash_vp, op11_line_dedup,
           op12_token_alignment, op13_prefix_trie, rule_ablations, pipeline)
    return {f.__name__: f for f in ops}


def llm_sql():
    return {"op3_quote_threads": quotes.SQL, "op4_rule_ledger": quality_rules.SQL, "rule_ablations": quality_rules.SQL_ABLATIONS,
            "op6_secret_ownership": secret_scan.SQL, "op7_radix_dedup": radix.SQL, "op8_source_mix": mixing.SQL,
            "op11_line_dedup": line_dedup.SQL, "op13_prefix_trie": prefix_trie.SQL}
