import json


def ask(params):
    if params["action"] == "parse":
        return json.dumps({"parse": {"text": "<p>x</p>"}})
    if "list" in params:
        return json.dumps({"n": 2} if params.get("at") else {"n": 1, "continue": {"at": "1"}})
    title = params["titles"]
    if title == "Broken":
        return json.dumps({"error": {"code": "internal"}})
    page = {"pageid": 1, "title": title, "extract": "She lies at a depth of 60 m.", "coordinates": [{"lat": 1.0, "lon": 2.0}]}
    if title == "Gone":
        page = {"missing": True}
    if title == "Many":
        page["pageprops"] = {"disambiguation": ""}
    return json.dumps({"query": {"pages": [page]}})
