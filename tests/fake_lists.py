"""A small encyclopedia; what it was asked is written down beside its address."""

import json
from pathlib import Path

LINK = '<a href="/wiki/{}">{}</a>'
PAGES = {
    "Lists of ship losses": LINK.format("List_of_ship_losses_in_1900", "1900") + LINK.format("List_of_gone", "gone") + LINK.format("HMS_A", "A"),
    "List of ship losses in 1900": '<h2>May</h2><table class="wikitable"><tr><th>Ship</th><th>Flag</th><th>Fate</th></tr><tr><td><a href="/wiki/HMS_A">HMS A</a></td><td>UK</td><td>Sank.</td></tr><tr><td>Nameless B</td><td>UK</td><td>Sank 20 m deep.</td></tr></table>',
}


def ask(folder, params):
    with open(Path(folder) / "asked", "a") as f:
        f.write(f"{params.get('page') or params.get('titles') or params.get('pageids') or params.get('pageid')}\n")
    if "page" in params:
        html = PAGES.get(params["page"])
        return json.dumps({"parse": {"text": html}} if html else {"error": {"code": "missingtitle"}})
    if params["action"] == "parse":
        return json.dumps({"parse": {"text": "<p>x</p>"}})
    if params.get("generator") == "images":
        info = lambda n: [{"url": f"https://f/{n}", "mime": "image/jpeg", "width": 800, "height": 600, "extmetadata": {"Artist": {"value": "<b>Ann</b> B"}, "LicenseUrl": {"value": "https://l"}}}]
        if "more" not in params:
            return json.dumps({"query": {"pages": [{"title": "File:Ship one.JPG", "imageinfo": info("1")}, {"title": "File:Flag of X.jpg", "imageinfo": info("f")}]}, "continue": {"more": "1"}})
        return json.dumps({"query": {"pages": [{"title": "File:Ship two.jpg", "imageinfo": info("2")}, {"title": "File:None.jpg"}]}})
    return json.dumps({"query": {"pages": [{"pageid": 7, "title": params["titles"], "extract": "She lies at a depth of 60 m.", "coordinates": [{"lat": 1.5, "lon": 2.0}]}]}})
