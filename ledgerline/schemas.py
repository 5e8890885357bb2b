"""Schemas of the record kinds the operators read, as DDL text."""

# Scalars are read as text so that 5 and "5" are the same value.
BOX_ITEM = "name string, star string, constellation string, level string"
MEMBER_ITEM = "name string, star string"
USER_RECORD = (
    "uid string, version string, "
    f"box struct<uid:string, characters:array<struct<{BOX_ITEM}>>>, "
    "record struct<uid:string, teams:array<struct<half:string, team_index:string, "
    f"members:array<struct<{MEMBER_ITEM}>>>>>")

# The same with list items as raw JSON, for records with an odd item: it must not blank its neighbours.
LOOSE_RECORD = "box struct<characters:array<string>>, record struct<teams:array<string>>"
LOOSE_TEAM = "half string, team_index string, members array<string>"

BUILD_MESSAGE = (
    "role string, ename string, star int, uid string, level int, constellation int, "
    "avg_damage bigint, weapon struct<name:string,refinement:int>, artifact_set struct<name:string>")
