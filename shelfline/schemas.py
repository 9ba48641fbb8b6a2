"""Schemas of the inputs and results, with real nulls and real types."""

from __future__ import annotations




GOODS = "G_NO string, CTRL_ROWID string, G_CLASS string, G_NAME string, G_POST_TIME timestamp, G_LASTUPDATE string, G_DIRECT_PRICE double, G_PRIORITY_ORDER string, G_CLOSE_DATE string, IS_DELETE string"
ADS = "G_NO string, CTRL_ROWID string, B_STATUS string, B_COIN string"
RANKS = "G_NO string, CTRL_ROWID string, RANK string"
SELLERS = "CTRL_ROWID string, APPLY_STATUS string, ASD_WEIGHT string, _SOURCE_TIME string"
REFINED = "CTRL_ROWID string, G_NO string, G_NAME string, RANK string, G_POST_TIME timestamp, GROUP_HEAD string, GROUP_NUM bigint, FINGERPRINT string"
DELTA = "G_NO string, FINGERPRINT string, HEAD boolean, GROUP_NUM bigint, IS_OLD string, ACTION string"
IMAGES = "G_NO string, IMG_HASH_V2 string"
