"""Schemas of the tables, as DDL."""

from __future__ import annotations

EXTRACTED = (
    "struct<name:string,company:string,title:string,phones:array<string>,emails:array<string>,websites:array<string>,"
    "wechat_ids:array<string>,qq_ids:array<string>,address:string,full_text:string>"
)
RECT = "struct<x:double,y:double,width:double,height:double>"
#: A page as the recognition service gives it.
PAGE = (
    f"file string, page int, ok boolean, request_id string, ocr_code int, line_texts array<string>, extracted {EXTRACTED}, "
    f"raw struct<code:int,message:string,request_id:string,http_status:int,data:struct<line_texts:array<string>,line_rects:array<{RECT}>>>, "
    "error string, http_like_code int, fatal boolean"
)
#: A card cut out of a page.
CARD = f"file string, page int, card_no int, grid_pos string, has_text boolean, line_texts array<string>, extracted {EXTRACTED}"
#: The flat projection of a card; arrays as text separated by semicolons.
CONTACT = (
    "file string, page string, card_no string, grid_pos string, has_text string, name string, company string, title string, "
    "phones string, emails string, websites string, wechat_ids string, qq_ids string, address string"
)
#: A standardised card.
STANDARD = (
    f"card_key string, source_label string, source_dataset string, file string, page int, card_no int, grid_pos string, line_texts array<string>, "
    f"rule_extracted {EXTRACTED}, llm_model string, name_std string, title_std string, company_std string, address_std string, mobiles array<string>, "
    "is_key_person boolean, kp_role string"
)
#: Columns of chain B's phone rows, in order.
PHONE_ROW_B = [
    "source_label", "source_dataset", "file", "page", "card_no", "grid_pos", "name_std", "title_std", "company_std", "address_std",
    "phone_normalized", "kp_role", "is_key_person", "pipeline",
]
#: What a run has done: one row per attempt at a unit of work.
RUN_LOG = "run string, input_fingerprint string, unit string, ok boolean, fatal boolean, error string, tokens bigint, at timestamp"
