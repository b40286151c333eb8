"""Types of the nested documents."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

S, I, L, B = StringType(), IntegerType(), LongType(), BooleanType()


def struct(**fields) -> StructType:
    return StructType([StructField(k, v) for k, v in fields.items()])


def array(of) -> ArrayType:
    return ArrayType(of)


#: What a strict reader makes of a raw record: text is stripped or null, lists hold only what they should.
RAW_RELATION = struct(word=S, lang_code=S)
RAW_EXAMPLE = struct(text=S, translation=S, has_english=B, type=S, ref=S)
RAW_SENSE = struct(
    glosses=array(S), raw_glosses=array(S), tags=array(S), qualifier=S, topics=array(S), examples=array(RAW_EXAMPLE),
    form_of=array(RAW_RELATION), alt_of=array(RAW_RELATION), compound_of=array(RAW_RELATION),
)
RAW_FORM = struct(form=S, tags=array(S), roman=S)
RAW_SOUND = struct(ipa=S, pronunciation_text=S, audio_url=S, ogg=B, mp3=B, wav=B, tags=array(S))
RAW_RECORD = struct(
    word=S, lang=S, lang_code=S, pos=S, word_folded=S, lang_code_folded=S, pos_folded=S, etymology_text=S,
    senses=array(RAW_SENSE), forms=array(RAW_FORM), sounds=array(RAW_SOUND),
    derived=array(RAW_RELATION), related=array(RAW_RELATION), synonyms=array(RAW_RELATION), antonyms=array(RAW_RELATION),
)

#: A scanned line: either a record or an anomaly.
SCANNED = struct(source_line=L, kind=S, detail=S, json_text=S, word=S, lang=S, lang_code=S, pos=S)

RELATION = struct(relation_type=S, target_word=S, target_lang_code=S, relation_flags=array(S), source_scope=S)
EXAMPLE = struct(text=S, translation=S, type=S, ref=S, example_flags=array(S))
SENSE = struct(
    sense_id=S, gloss=S, raw_gloss=S, tags=array(S), qualifier=S, topics=array(S), examples=array(EXAMPLE), relations=array(RELATION), sense_flags=array(S)
)
FORM = struct(form=S, tags=array(S), roman=S, form_flags=array(S))
PRONUNCIATION = struct(ipa=S, pronunciation_text=S, audio_url=S, audio_format=S, tags=array(S), pronunciation_flags=array(S))
POS_GROUP = struct(
    pos=S, pos_flags=array(S), etymology_id=S, senses=array(SENSE), forms=array(FORM), pronunciations=array(PRONUNCIATION), relations=array(RELATION)
)
ETYMOLOGY_GROUP = struct(etymology_id=S, etymology_text=S, etymology_flags=array(S), member_pos=array(S), source_refs=array(struct(raw_record_id=L)))
RECORD_REF = struct(snapshot_id=S, run_id=S, raw_record_id=L, source_line=L, pos=S)
SOURCE_SUMMARY = struct(raw_record_count=I, raw_snapshot_ids=array(S), raw_run_ids=array(S), raw_record_refs=array(RECORD_REF))
ENTRY = struct(
    entry_id=S, word=S, normalized_word=S, lang=S, lang_code=S, entry_flags=array(S), source_summary=SOURCE_SUMMARY,
    etymology_groups=array(ETYMOLOGY_GROUP), pos_groups=array(POS_GROUP),
)
TRIAGE = struct(
    lang_code=S, word=S, reason_code=S, severity=S, suggested_action=S, raw_record_refs=array(RECORD_REF),
    payload=struct(pos=S, dominant_relation=S, sense_index=I), status=S,
)

#: Fields of a response, as validators leave them.
GENERATED_EXAMPLE = struct(text=S, translation=S)
GENERATED_MEANING = struct(sense_id=S, priority=S, short_gloss=S, learner_explanation=S, usage_note=S, examples=array(GENERATED_EXAMPLE))
GENERATED_GROUP = struct(pos_group_id=S, pos=S, summary=S, usage_note=S, meanings=array(GENERATED_MEANING))
RESPONSE = struct(headword_summary=S, memory_hook=S, study_notes=array(S), etymology_note=S, pos_groups=array(GENERATED_GROUP))
