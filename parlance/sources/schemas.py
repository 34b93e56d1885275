"""Schemas of raw records."""

from __future__ import annotations

USER = "id bigint, first_name string, last_name string, username string, phone string, is_bot boolean, is_deleted boolean, usernames array<string>"
CHAT = "id bigint, kind string, title string, username string, is_archived boolean, is_forum boolean, migrated_to bigint, is_accessible boolean, participant_count int, participant_ids array<bigint>"
ENTITY = "struct<type:string,offset:int,length:int,url:string,user_id:bigint>"
MESSAGE = (
    f"chat_id bigint, id bigint, date timestamp, sender_id bigint, sender_kind string, text string, entities array<{ENTITY}>, reply_to_id bigint, topic_id bigint, "
    "forward struct<kind:string,from_id:bigint,from_name:string,date:timestamp>, media struct<kind:string,ext:string,mime:string,size:bigint,duration:int,file_name:string>, "
    "action string, edit_date timestamp, grouped_id bigint, via_bot_id bigint, post_author string"
)
CURSOR = "chat_id bigint, last_id bigint, appended bigint, updated_at timestamp"
INSPECTION = f"me_id bigint, chat_id bigint, inspected_at timestamp, users array<struct<{', '.join(f.strip().replace(' ', ':', 1) for f in USER.split(','))}>>, complete boolean, error string, participants_count int, migrated_from_id bigint"
