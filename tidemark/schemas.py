"""Record kinds and their schemas."""

from __future__ import annotations

# Kinds of records that may be pulled, and limits in bytes.
RECORD_TYPES = ("event", "entity_snapshot", "page_dwell", "exception", "media_segment")
MAX_RECORD = 1_048_576

ENVELOPE = "id string, site_id string, captured_at string, record_type string, plugin_version long, moodle_version long"
EVENT = ENVELOPE + ", event_name string, event_data string, moodle_site_identifier string, client_ip string, user_agent string, truncated boolean"
SNAPSHOT = ENVELOPE + ", entity string, snapshot_batch string, entity_data string"
DWELL_BODY = "userid long, courseid long, contextid long, contextlevel int, contextinstanceid long, page string, url string, timespent_ms long, started_at string, media_id string, media_kind string, media_pos_sec int, bucket_sec int"
DWELL = ENVELOPE + f", client_ip string, user_agent string, dwell struct<{', '.join(f.replace(' ', ':', 1) for f in DWELL_BODY.split(', '))}>"
EXCEPTION = ENVELOPE + ", entity string, error_class string, error_message string, error_file string, error_line int, stack_trace string, userid long, courseid long, url string"
PULL_ROW = "id string, captured_at string, record_type string, entity string, data string"
OVERRIDES = "id long, datatype string, enabled int, tabletype int, discovered int, custom_columns string, custom_table string, notes string, timecreated long, timemodified long"
OP_LOG = "id long, type string, datatype string, action string, details string, timecreated long"
PARTICIPANT = "id long, sessionuid string, useruid string, external_user_id long, role string, display_name string, first_join_time long, last_left_time long, duration long, rejoins long, timecreated long"
SYNC_MARKER = "id long, sessionuid string, timesynced long"
ATTENDEES = "array<struct<userId:string,externalUserId:string,role:string,displayName:string,attendance:array<struct<joined:string,left:string,duration:long>>>>"
