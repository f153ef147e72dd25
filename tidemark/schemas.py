"""Fixed schemas of the inputs and the output tables."""

from pyspark.sql import types as T

_S, _L, _B, _TS = T.StringType(), T.LongType(), T.BooleanType(), T.TimestampType()


def _st(*fields: tuple) -> T.StructType:
    """Fields (name, type) or (name, type, False) for one that is never null."""
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


MESSAGE = _st(
    ("message_id", _S),
    ("source", _st(("channel_name", _S), ("source_name", _S), ("src_sys_name", _S), ("src_sys_conv_id", _S))),
    ("message", _st(("content", _st(("header", _S), ("raw_text", _S), ("subject", _S), ("clean_text", _S))))),
    (
        "attachments",
        T.ArrayType(_st(("metadata", _st(("attachment_id", _S), ("parent_attachment_id", _S), ("file_name", _S))), ("content", _st(("clean_text", _S))))),
    ),
    ("processing", _st(("run_date", _S), ("run_hour", _S))),
)
VIEW_COLUMNS = (
    "process_id message_id dataset_partition feature_tagging_type feature_type feature_id feature_name sub_feature_type "
    "features_to_apply is_noise_reduction operator feature_definition feature_partition_value policy_engine_id"
).split()
VIEW = _st(*((c, _S) for c in VIEW_COLUMNS))
DEFINITION = _st(
    ("featureName", _S), ("featureType", _S), ("isNoiseReduction", _B),
    ("body", _st(("feature", _S), ("totalTermsCount", T.IntegerType()), ("minimumHits", T.IntegerType()), ("scope", T.ArrayType(_S)))),
)
_INTS = T.ArrayType(T.IntegerType())
TERMS = _st(
    (
        "results",
        T.ArrayType(
            _st(
                ("termId", _S), ("compilationStatus", _S), ("translatedPattern", T.ArrayType(_S)), ("requiresExclusionCheck", _B),
                ("hyperscanExpressionId", T.IntegerType()), ("requiredExpressionIds", _INTS), ("excludedExpressionIds", _INTS),
            )
        ),
    ),
)

EXPRESSIONS = _st(("expressions", T.ArrayType(_st(("id", T.IntegerType()), ("pattern", _S), ("flags", _S), ("kind", _S)))))

LEXICON_HIT_SUMMARY = _st(
    ("message_id", _S, False), ("process_id", _S, False), ("pipeline_exec_id", _S, False),
    ("evaluated_lexicons", T.ArrayType(_st(
        ("id", _S, False), ("name", _S), ("total_terms_count", _L, False), ("regex_hit_count", _L, False),
        ("term_dtls", T.ArrayType(_st(("term_id", _S, False), ("term_regex_pattern", _S), ("regex_match_hit_count", _L, False)))),
    )), False),
    ("created_by", _S, False), ("created_ts", _TS, False),
)
LEXICON_HIT_DETAIL = _st(
    ("message_id", _S, False), ("process_id", _S, False), ("pipeline_exec_id", _S, False), ("dataset_partition_value", _S, False),
    ("evaluated_lexicons", T.ArrayType(_st(("id", _S, False), ("term_dtls", T.ArrayType(_st(("term_id", _S, False), ("matched_text", _S, False)))))), False),
    ("created_by", _S, False), ("created_ts", _TS, False),
)
FEATURE_HIT_SUMMARY = _st(
    ("message_id", _S, False), ("dataset_partition_value", _S, False), ("pipeline_exec_id", _S, False), ("process_id", _S, False), ("feature_hit_type", _S),
    ("features", T.ArrayType(_st(
        ("id", _L), ("name", _S), ("type", _S), ("is_noise_reduction", _B, False), ("hit_status", _B, False),
        ("sub_features", T.ArrayType(_st(("type", _S), ("name", _S), ("hit_status", _B, False)))),
    )), False),
    ("created_by", _S, False), ("created_ts", _TS, False),
)
STAGE_AUDIT = _st(
    ("process_id", _S, False), ("trigger_type", _S, False), ("pipelinex_exec_id", _S, False), ("stage_name", _S, False), ("composer_dag_name", _S),
    ("composer_dag_path", _S), ("dproc_dag_name", _S), ("dproc_dag_path", _S), ("start_time", _TS), ("end_time", _TS), ("job_status", _S, False),
    ("error_count", _S), ("error_message", _S), ("additional_info", _S), ("execution_date", T.DateType(), False),
)
RECORD_AUDIT = _st(
    ("process_id", _S, False), ("trigger_type", _S, False), ("pipelinex_exec_id", _S, False), ("stage_name", _S, False), ("record_id", _S, False),
    ("status", _S, False), ("return_code", T.IntegerType()), ("error_message", _S), ("execution_date", T.DateType(), False),
    ("created_by", _S, False), ("created_ts", _TS, False),
)
