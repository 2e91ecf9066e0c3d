"""How often the stateful functions call the state store, which is what their time goes into."""

from datetime import date, datetime
from types import SimpleNamespace

from pyspark.sql import Row

from eqscene.streaming import forward, tracker

T, LATER, DAY = datetime(2024, 1, 10, 12), datetime(2024, 1, 12, 6), date(2024, 1, 12)
RING = [{"x": x, "y": y} for x, y in ((0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0))]


class Store:
    def __init__(self, calls):
        self.calls, self.value, self.entries = calls, None, {}

    def __getattr__(self, name):
        def call(*args):
            self.calls.append(name)
            if name == "update":
                self.value = args[0]
            return {"exists": self.value is not None, "get": self.value, "iterator": iter(self.entries.items())}.get(name)

        return call


def _started(processor):
    calls = []
    handle = SimpleNamespace(getValueState=lambda *_: Store(calls), getMapState=lambda *_: Store(calls))
    processor.init(handle)
    return processor, calls


def test_a_track_found_at_once_costs_one_read_and_one_write():
    p, calls = _started(forward.TrackLifecycle())
    scene = Row(kind="scene", start_time=LATER, event_time=T, acq_date=DAY, scene_id="s", pos=1, ring=RING, area=None, minx=0.0, miny=0.0, maxx=1.0, maxy=1.0)
    (out,) = p.handleInputRows(("e", "A_1"), iter([Row(kind="track"), scene]), None)
    assert (out.due, out.post_date, out.granules) == (True, DAY, ["s"]) and calls == ["get", "update"]


def test_a_pass_over_a_waiting_track_costs_one_read_and_one_write():
    p, calls = _started(tracker.TrackProcessor())
    rows = [Row(kind="mosaic", start_time=LATER, event_time=T, acq_date=DAY, area=1.0), Row(kind="result", result="Success")]
    (out,) = p.handleInputRows(("e", "A_1"), iter(rows), None)
    assert (out.status, out.post_date) == (tracker.READY, DAY) and calls == ["get", "update"]
