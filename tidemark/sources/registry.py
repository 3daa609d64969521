"""Entities: what is exported, from which table, with which columns and watermark."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, replace

# The entities, one for each table of that name, and the one that is derived.
ENTITY_NAMES = """
    user course course_categories course_sections context enrol user_enrolments role role_assignments course_modules modules
    course_modules_completion course_completions grade_items grade_grades quiz quiz_attempts assign assign_submission assign_grades forum
    forum_discussions forum_posts cohort cohort_members groups groups_members grade_categories grade_letters grade_outcomes scale
    user_info_category user_info_field user_info_data customfield_category customfield_field customfield_data course_completion_criteria
    feedback feedback_item feedback_completed feedback_value survey survey_answers grading_areas grading_definitions grading_instances
    gradingform_rubric_criteria gradingform_rubric_levels gradingform_rubric_fillings lti lti_types lti_submission question
    question_categories question_attempts question_attempt_steps question_attempt_step_data quiz_slots question_bank_entries
    question_references question_versions scorm scorm_scoes scorm_scoes_track scorm_attempt attendance attendance_sessions attendance_log
    attendance_statuses badge badge_issued customcert customcert_issues collaborate competency competency_framework competency_coursecomp
    competency_modulecomp competency_usercomp competency_usercompcourse competency_usercompplan competency_plan competency_plancomp
    competency_templatecomp bigbluebuttonbn bigbluebuttonbn_logs bigbluebuttonbn_recordings messages message_conversations
    message_conversation_members message_user_actions user_lastaccess userlogins assign_user_flags org org_framework pos pos_framework
    job_assignment tool_tenant tool_tenant_user questionnaire questionnaire_dependency questionnaire_question questionnaire_quest_choice
    questionnaire_question_type questionnaire_response questionnaire_resp_single questionnaire_resp_multiple questionnaire_response_rank
    questionnaire_response_text questionnaire_response_bool questionnaire_response_date questionnaire_response_other questionnaire_survey
    questionnaire_attempts lesson lesson_pages lesson_attempts workshop choice choice_answers h5pactivity h5pactivity_attempts data
    data_content data_fields data_records wiki glossary glossary_entries chat chat_messages url page resource book folder label imscp files
    tag tag_instance event grade_grades_history grade_items_history gradingform_guide_criteria gradingform_guide_fillings quiz_grades
    quiz_statistics question_answers question_statistics question_usages survey_questions assign_user_mapping assignment
    assignfeedback_comments competency_template competency_templatecohort competency_evidence course_format_options role_context_levels
    tool_cohortroles enrol_paypal enrol_lti_tools message
""".split()
DERIVED = {"userlogins": "logstore_standard_log"}

# Change columns in the order in which they are looked for, and entities that have their own.
WATERMARK_COLUMNS = ("timemodified", "timeupdated", "timecreated", "timeaccess", "timeadded")
OWN_WATERMARKS = {
    "course_modules": "added",
    "forum_posts": "modified",
    "survey_answers": "time",
    "attendance_log": "timetaken",
    "lesson_attempts": "timeseen",
    "chat_messages": "timestamp",
}

# Columns with credentials, by name anywhere or in one table; columns with private messages.
FORBIDDEN_COLUMNS = (
    "password",
    "secret",
    "secretkey",
    "accesskey",
    "enrolmentkey",
    "resourcekey",
    "servicesalt",
    "privatekey",
    "apikey",
    "token",
    "seatkey",
    "sessdata",
    "clientsecret",
    "refreshtoken",
    "consumersecret",
    "privatetoken",
    "confirmtoken",
    "guestpassword",
    "quitpassword",
    "authtoken",
)
FORBIDDEN_TABLE_COLUMNS = {"user_private_key": ("value",), "sessions": ("sid",)}
#: The same for tables whose name ends so, whatever component they belong to: codes that are worth money.
FORBIDDEN_SUFFIX_COLUMNS = {"_coupons": ("code",)}
MESSAGE_COLUMNS = ("fullmessage", "fullmessagehtml", "smallmessage")
MESSAGE_ENTITIES = ("messages", "message")


@dataclass(frozen=True)
class Entity:
    """columns: None for all columns of the live table; watermark: a change column of its own."""

    name: str
    table: str
    columns: tuple[str, ...] | None = None
    watermark: str | None = None
    derived: bool = False


@dataclass(frozen=True)
class Override:
    """An administrator's row about one entity."""

    datatype: str
    enabled: bool = True
    tabletype: int | None = None
    discovered: bool = False
    custom_columns: str | None = None
    custom_table: str | None = None


@dataclass(frozen=True)
class Resolved:
    """Columns that the live table has, those it lacks, and the change column among the former."""

    columns: tuple[str, ...] | None
    missing: tuple[str, ...]
    watermark: str | None


Live = Callable[[str], list[str] | None]


def built_in(declared: Mapping[str, Iterable[str]] | None = None, more: Mapping[str, str] | None = None) -> dict[str, Entity]:
    """The registry: one entity a table; declared column lists and further entities (name to table) are parameters."""
    declared = {k: tuple(v) for k, v in (declared or {}).items()}
    out = {n: Entity(n, DERIVED.get(n, n), declared.get(n), OWN_WATERMARKS.get(n), n in DERIVED) for n in ENTITY_NAMES}
    return out | {n: Entity(n, t, declared.get(n)) for n, t in (more or {}).items()}


def names_in(raw: str | None) -> list[str]:
    return [x for x in re.split(r"[\s,]+", raw or "") if x]


def intersected(declared: Iterable[str], live: list[str]) -> tuple[list[str], list[str]]:
    """Declared names that the table has, as the table spells them, and those it lacks."""
    spelled = {c.lower(): c for c in live}
    have, missing = [], []
    for c in declared:
        (have.append(spelled[c.lower()]) if c.lower() in spelled else missing.append(c))
    return list(dict.fromkeys(have)), missing


def watermark_of(columns: Iterable[str], own: str | None = None) -> str | None:
    have = {c.lower() for c in columns}
    return own.lower() if own and own.lower() in have else next((c for c in WATERMARK_COLUMNS if c in have), None)


def resolved(entity: Entity, live: Live) -> Resolved | None:
    """None if `id` isn't among the columns that are left. Where the table can't be looked into, the declared list stands."""
    columns = live(entity.table)
    if not columns:
        return Resolved(entity.columns, (), watermark_of(entity.columns, entity.watermark) if entity.columns else None)
    if entity.columns is None:
        return Resolved(tuple(columns), (), watermark_of(columns, entity.watermark))
    have, missing = intersected(entity.columns, columns)
    if "id" not in {c.lower() for c in have}:
        return None
    return Resolved(tuple(have), tuple(missing), watermark_of(have, entity.watermark))


def forbidden_for(entity: Entity, bodies: bool = False, by_table: Mapping[str, Iterable[str]] = FORBIDDEN_TABLE_COLUMNS) -> set[str]:
    """Lower-case names of the columns that an entity never exports."""
    table = entity.table.lower()
    out = set(FORBIDDEN_COLUMNS) | {c.lower() for t, cs in by_table.items() if t.lower() == table for c in cs}
    out |= {c for end, cs in FORBIDDEN_SUFFIX_COLUMNS.items() if table.endswith(end) for c in cs}
    return out | (set(MESSAGE_COLUMNS) if entity.name in MESSAGE_ENTITIES and not bodies else set())


def stripped(registry: Mapping[str, Entity], live: Live, bodies: bool = False, by_table: Mapping[str, Iterable[str]] = FORBIDDEN_TABLE_COLUMNS) -> dict[str, Entity]:
    """Every entity without its forbidden columns; `id` is left if nothing else is. A whole row is listed out only if it must be."""
    out = {}
    for name, e in registry.items():
        never = forbidden_for(e, bodies, by_table)
        listed = e.columns if e.columns is not None else live(e.table) or ()
        left = tuple(c for c in listed if c.lower() not in never)
        changed = len(left) != len(listed)
        out[name] = replace(e, columns=(left or ("id",)) if changed else e.columns)
    return out


def merged(registry: Mapping[str, Entity], overrides: Iterable[Override], live: Live, whole_row_prefix: str = "local_") -> dict[str, Entity]:
    """The registry under the administrator's rows: switched off, columns of their own, discovered whole, or new."""
    out = dict(registry)
    for o in overrides:
        if not o.enabled:
            out.pop(o.datatype, None)
            continue
        asked = names_in(o.custom_columns)
        if e := out.get(o.datatype):
            if asked:
                have, _ = intersected(asked, live(e.table) or [])
                out[o.datatype] = replace(e, columns=tuple(have)) if have else e
            elif o.discovered and e.table.startswith(whole_row_prefix):
                out[o.datatype] = replace(e, columns=None)
        elif (table := (o.custom_table or "").strip()) and live(table):
            have, _ = intersected(asked, live(table) or [])
            out[o.datatype] = Entity(o.datatype, table, tuple(have) or None)
    return out


def effective(registry: Mapping[str, Entity], overrides: Iterable[Override], live: Live, bodies: bool = False, by_table: Mapping[str, Iterable[str]] = FORBIDDEN_TABLE_COLUMNS) -> dict[str, Entity]:
    """What is exported: overrides merged, then forbidden columns taken out, so that no override brings one back."""
    return stripped(merged(registry, overrides, live), live, bodies, by_table)


def discovered(tables: Iterable[str], prefixes: Iterable[str], root: str = "local_") -> list[str]:
    """Tables that begin with a prefix; prefixes outside the root are dropped."""
    usable = tuple(p for p in prefixes if p.startswith(root))
    return sorted({t for t in tables if usable and t.startswith(usable)})
