"""A layer of 25 features served from memory, for the data source's fetcher option."""

import re

FEATURES = [{"OBJECTID": i * 3, "CODE": "13A" if i % 2 else "220", "DATE_REPORTED": 1_700_000_000_000 + i} for i in range(1, 26)]


def fetch(url, params):
    if not url.endswith("/query"):
        return {"fields": [{"name": "OBJECTID", "type": "esriFieldTypeOID"}, {"name": "CODE", "type": "esriFieldTypeString"}, {"name": "DATE_REPORTED", "type": "esriFieldTypeDate"}]}
    rows = list(FEATURES)
    for sign, n in re.findall(r"OBJECTID (>|<=) (\d+)", params["where"]):
        rows = [r for r in rows if (r["OBJECTID"] > int(n) if sign == ">" else r["OBJECTID"] <= int(n))]
    if m := re.search(r"CODE = '(\w+)'", params["where"]):
        rows = [r for r in rows if r["CODE"] == m[1]]
    if params.get("returnCountOnly"):
        return {"count": len(rows)}
    rows.sort(key=lambda r: r["OBJECTID"], reverse=params.get("orderByFields", "").endswith("DESC"))
    return {"features": [{"attributes": r} for r in rows[: params["resultRecordCount"]]]}
