"""Explicit schemas of the raw logs; nothing is inferred from the data."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(spec: str) -> T.StructType:
    return T._parse_datatype_string(spec)  # needs a running session


_STRINGS = "{} string".format

# Names and types of the raw log fields.
# name -> DDL text; kept as DDL so that it can be read without a session
LOGS = {
    "visit_ad": "aid string, channel_code string, area string, ip string, create_time timestamp",
    "visit_fad": ", ".join(_STRINGS(c) for c in (
        "udid", "deviceid", "imsi", "imei", "vender", "model", "osVersion", "platform", "androidid",
        "operator", "network", "src", "mac", "apppkg", "clnt", "isroot", "gp", "gaid", "rom", "lang",
        "ua", "cityid", "country", "appversion", "sdkver", "path", "logtype", "runlevel",
    )) + ", createtime timestamp, updatetime timestamp",
    "visit_sdk": ", ".join(_STRINGS(c) for c in (
        "uuid", "deviceid", "appkey", "customid", "network", "platform", "havaapn", "imsi", "wifimac",
        "imei", "androidid", "baseband", "language", "resolution", "modulename", "cpu", "devicename",
        "osVersion", "cameras",
    )) + ", exttotalsize long, romtotalsize long, phoneno string, city string, region string,"
         " country string, uidtype string, version string, pkgpath string, logtype int,"
         " createtime timestamp",
    "visit_rich": "uuid string, appkey string, customid string, createtime timestamp, time timestamp,"
                  " boottime long, version string, extsizeleft long, romsizeleft long, screenon int,"
                  " battery int, logtype int, city string, region string, country string,"
                  " clientip string",
    "using_log": "deviceid string, appkey string, session_id string, start_millis timestamp,"
                 " duration long, version string",
    "event": "deviceid string, eventid string, acc string, label string, version string,"
             " insertdate string, date string",
    "ad_request": "adcode string, udid string, adkey string, adverid long, position long,"
                  " apppkg string, clnt string, cityid long, createtime timestamp",
    "ad_reply": "adcode string, udid string, createtime timestamp, rtype int",
    "upgrade_log": "udid string, apppkg string, appversion string, upversion string,"
                   " createtime timestamp",
    "adv_visitlog": "androidid string, custom_id string, create_time timestamp, city_id int,"
                    " nettype int, version string, advids string, hisshow string, hisclick string,"
                    " hisinstall string",
    "adv_apilog": "androidid string, ids string, apishow string, apiclick string,"
                  " create_time timestamp, apiurl string, clickurl string, custom_id string,"
                  " imei string, title string, adtype string",
    "delimited_event": "log_date string, appkey string, deviceid string, version string,"
                       " eventid string, acc string, insertdate string, category string,"
                       " label string",
}


def log_schema(name: str) -> T.StructType:
    """The schema of a log by name; raises ``KeyError`` for a log that is not known."""
    return _schema(LOGS[name])
