import json


def ask(address, params):
    if address.endswith("/MapServer"):
        layers = [{"id": 3, "name": "X.Wreck_point", "subLayerIds": None}, {"id": 4, "name": "X.Wreck", "subLayerIds": [3]}] if "harbour" in address else []
        return json.dumps({"layers": layers})
    if params.get("returnIdsOnly"):
        return json.dumps({"objectIds": [3, 1, 2]})
    ids = [int(i) for i in params["objectIds"].split(",")]
    return json.dumps({"features": [{"id": i, "geometry": {"type": "Point", "coordinates": [-70.0, 40.0 + i]}, "properties": {"objnam": f" N{i} ", "CATWRK": "2", "VALSOU": 1.5}} for i in reversed(ids)]})
