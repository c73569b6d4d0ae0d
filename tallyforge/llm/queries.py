"""The registered queries of the corpus operators and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.llm import byte_bpe, chat, exact, jaccard, language, lines, mixing, near_vectors, pieces, pii, prefix_trie, quality, repair
from tallyforge.llm.common import ship, table

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def register(build):
        def run(spark, sf_dir):
            ship(spark)
            return build(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query("op1_near_vectors", near_vectors.VECTORS_SQL)
def near_embeddings(spark, sf_dir):
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op2_exact_dedup", exact.EXACT_SQL)
def exact_dedup(spark, sf_dir):
    return exact.exact_groups(table(spark, sf_dir, "documents"))


@query("op3_source_mix", f"WITH {mixing.mix_sql()} SELECT * FROM mix")
def source_mix(spark, sf_dir):
    return mixing.poisson_mix(table(spark, sf_dir, "documents"))


@query("op6_jaccard_join", jaccard.JACCARD_SQL)
def jaccard_join(spark, sf_dir):
    return jaccard.jaccard_groups(table(spark, sf_dir, "documents")).drop("set_key")


@query("op7_line_dedup", lines.LINES_SQL)
def line_dedup(spark, sf_dir):
    out = lines.drop_repeated_runs(table(spark, sf_dir, "documents"))
    return out.select("row.doc_id", "text", "n_lines", "n_deleted")


@query("op4_pii")
def personal_data(spark, sf_dir):
    return pii.find_pii(table(spark, sf_dir, "documents"))


@query("op5_chat_format", chat.CHAT_SQL)
def chat_format(spark, sf_dir):
    turns = chat.with_control_case(table(spark, sf_dir, "conversations"))
    return chat.conversation_digests(chat.format_turns(turns, window=chat.INST_WINDOW))


@query("op8_sentencepiece")
def sentencepiece_n_best(spark, sf_dir):
    out = pieces.decode(pieces.encode(table(spark, sf_dir, "documents")))
    nbest = F.concat(F.array("score"), F.transform("alternatives", lambda a: a["score"]))
    return out.select("doc_id", F.size("ids").cast("bigint").alias("n_pieces"), "ids", nbest.alias("nbest_scores"), "alternatives",
                      F.sha2("text", 256).alias("decoded_sha256"))


@query("op9_quality")
def quality_classifier(spark, sf_dir):
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_language")
def language_id(spark, sf_dir):
    return language.languages(table(spark, sf_dir, "documents"))


@query("op11_byte_bpe")
def byte_level_bpe(spark, sf_dir):
    return byte_bpe.token_digests(byte_bpe.decode(byte_bpe.encode(table(spark, sf_dir, "documents"))))


@query("op12_conversation_repair", repair.REPAIR_SQL)
def conversation_repair(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return repair.repair_report(turns, repair.damaged(turns))


@query("op13_prefix_trie", prefix_trie.TRIE_SQL)
def conversation_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(prefix_trie.rebuilt_keys(prefix_trie.conversation_keys(table(spark, sf_dir, "conversations"))))
