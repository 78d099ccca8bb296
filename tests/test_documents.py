"""SVG and EPS documents, rasters, vision requests and settings, on small written-out cases."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkspool import eps, raster, settings, svg, vision
from inkspool.operators import assets, paths, pixels, upsert
from inkspool.session import Scratch
from inkspool.sources import tables

NS = 'xmlns="http://www.w3.org/2000/svg"'


def test_svg_rewrites():
    doc = lambda body, head='viewBox="0 0 10 10"': svg.parse(f"<svg {NS} {head}>{body}</svg>")
    data = lambda root: [p.get("d") for p in root.iter(f"{{{svg.SVG}}}path")]
    assert data(svg.rounded(doc('<path d="M1.0005,1.0005000000001 L -0.0001 2e1 z"/>'))) == ["M 1 1.001 L 0 20 z"]
    assert data(svg.without_repeats(doc('<path d="M 0 0 L 1 1 L 1 1 L 1 1 2 2 L 1 1 2 2 l 1 1 l 1 1"/>'))) == ["M 0 0 L 1 1 L 1 1 2 2 L 1 1 2 2 l 1 1 l 1 1"]
    one, two, near = (f'<path fill="#f00" d="M {x} 0 L {x + 1} 1 Z"/>' for x in (0, 5, 0.5))
    assert len(data(svg.joined(doc(one + two)))) == 1 and len(data(svg.joined(doc(one + near)))) == 2
    assert len(data(svg.joined(doc(one + '<g transform="scale(2)"/>' + two)))) == 2 and len(data(svg.joined(doc(one + two.replace("f00", "0f0"))))) == 2
    assert len(data(svg.joined(doc(one + two.replace("L", "l"))))) == 2 and len(data(svg.joined(doc(one + two.replace("<path", '<path id="x"'))))) == 2
    for target, box in ((15, "0 0 3 7"), (25, "-5 -5 1e1 2e1"), (65, "0 0 7 3")):
        out = svg.facts(svg.sized(doc("", f'viewBox="{box}"'), target))
        assert 15e6 <= out["width"] * out["height"] <= 65e6 and abs(out["width"] * out["height"] / 1e6 - target) < 0.02
    assert svg.facts(svg.sized(doc("", 'width="1in" height="2in"'), 16, "icon"))["height"] == 4000
    for bad, kind, target in (('viewBox="0 0 1 2000"', "illustration", 25), ('viewBox="0 0 0 1"', "illustration", 25), ('width="-5px" height="1"', "illustration", 25), ('viewBox="0 0 1 90"', "icon", 16), ('viewBox="0 0 1 1"', "illustration", 14), ('viewBox="0 0 1 1"', "icon", 17)):
        with pytest.raises(ValueError):
            svg.sized(doc("", bad), target, kind)
    for bad in ("<html/>", f'<!DOCTYPE svg [<!ENTITY a "b">]><svg {NS}/>'):
        with pytest.raises(ValueError):
            svg.parse(bad)
    root = svg.described(svg.described(doc(one), "old", ["x"]), "A & B", ["k1", "k2"])
    text = svg.written(root).decode()
    assert text.count("<metadata") == 1 and "old" not in text and text.count("A &amp; B") == 2 and text.count("<rdf:li>k") == 2 and svg.written(svg.parse(text)).decode() == text
    assert svg.facts(svg.parse(f'<svg {NS} width="1" height="2"><path/><g><path/><image/><text/></g></svg>')) == {"width": 1.0, "height": 2.0, "view_box": None, "paths": 2, "images": 1, "texts": 1}


def test_svg_rows_keep_their_errors(spark):
    df = spark.createDataFrame([(1, f'<svg {NS} width="3" height="7"/>'), (2, "<x"), (3, None)], "asset_id long, svg string")
    got = {r.asset_id: (r.ok, r.error) for r in svg.rewritten(df, lambda root: svg.sized(root, 15)).collect()}
    assert got[1] == (True, None) and not got[2][0] and "ParseError" in got[2][1] and not got[3][0]


def test_eps(spark):
    good = b"%!PS-Adobe-3.0 EPSF-3.0\n%%BoundingBox: 0 0 5000 5000\n"
    rows = [good, b"%!PS-Adobe-3.0\n%%BoundingBox: 0 0 5000 5000\n", good.replace(b"5000 5000", b"0 5000"), good.replace(b"5000 5000", b"500 500"), b"%!PS", None]
    df = spark.createDataFrame([(k, bytearray(r) if r else None) for k, r in enumerate(rows)], "k int, content binary").orderBy("k")
    assert [r[0]["error"] for r in df.select(eps.structure(F.col("content"))).collect()] == [None, "head", "bounds", "artboard", "size", "size"]
    assert df.select(eps.structure(F.col("content"), "icon")["error"]).collect()[3][0] is None
    icon = b"%!PS-Adobe-3.0 EPSF-3.0\n%%BoundingBox: 1 2 30 40\n%%HiResBoundingBox: 1.5 2 30 40\n%%Other: 1\n"
    assert eps.on_artboard(icon, 100, 90) == b"%!PS-Adobe-3.0 EPSF-3.0\n%%BoundingBox: 0 0 100 90\n%%HiResBoundingBox: 0 0 100 90\n%%Other: 1\n"
    with pytest.raises(ValueError, match="outside"):
        eps.on_artboard(icon, 20, 90)
    seen = []
    engine = eps.converter(lambda raw: seen.append(svg.parse(raw)) or icon, 16, "icon")
    assert b"0 0 4000 4000" in engine(f'<svg {NS} width="1" height="1"/>'.encode()) and seen[0].get("width") == "4000pt"
    copy = eps.command(["cp", "{input}", "{output}"], (".a", ".b"), 5)
    assert copy(b"xyz") == b"xyz"
    with pytest.raises(RuntimeError):
        eps.command(["false"], (".a", ".b"), 5)(b"")


def test_rasters():
    rng = np.random.default_rng(1)
    for shape in ((5, 7, 3), (4, 4, 4), (3, 9, 1)):
        a = rng.integers(0, 256, shape).astype(np.uint8)
        assert (raster.read_png(raster.write_png(a)) == a).all()
    with pytest.raises(ValueError):
        raster.read_png(b"not an image")
    assert raster.as_rgb(np.array([[[0, 0, 0, 0], [10, 20, 30, 255]]], np.uint8)).tolist() == [[[255, 255, 255], [10, 20, 30]]]
    assert raster.as_rgb(np.array([[[65535]]], np.uint16)).tolist() == [[[255, 255, 255]]]
    half = raster.resized(np.kron(np.array([[0, 200], [100, 50]], np.uint8)[..., None].repeat(3, 2), np.ones((4, 4, 1), np.uint8)), 2)
    assert half[:, :, 0].tolist() == [[0, 200], [100, 50]] and raster.resized(half, 100) is not None and raster.resized(half, 100).shape == (2, 2, 3)
    picture = np.full((64, 64, 3), 255, np.uint8)
    picture[8:24, 8:24] = (0, 0, 0)
    picture[30:50, 30:50] = (200, 10, 10)
    centres, weights, buckets = raster.palette(picture.reshape(-1, 3))
    assert centres.round().tolist() == [[255, 255, 255], [200, 10, 10], [0, 0, 0]] and weights.tolist() == [64 * 64 - 656, 400, 256] and buckets == 3
    assert raster.white_border(picture) and not raster.white_border(255 - picture)
    hole = np.zeros((40, 40), bool)
    hole[5:35, 5:35] = True
    hole[15:25, 15:25] = False
    alpha = np.where(hole, 255, 0)
    assert raster.region_failures(hole, alpha, True) == (1, 0) and raster.region_failures(hole, alpha, False) == (2, 0)
    alpha[15:25, 15:25] = 255  # a filled hole cannot hide among the rest
    assert raster.region_failures(hole, alpha, False) == (2, 1)
    sheet = np.full((100, 100, 3), 255, np.uint8)
    sheet[10:60, 20:80], sheet[85:92, 30:60] = 0, 0
    clean = raster.without_captions(sheet, 1, 1)
    assert (clean[85:92] == 255).all() and (clean[10:60, 20:80] == 0).all()
    dust = picture.copy()
    dust[2:4, 2:4] = (1, 2, 3)
    assert raster.specks(dust).sum() == 4 and raster.specks(picture).sum() == 0
    assert (raster.opened_and_closed(dust)[2:4, 2:4] == 255).all() or (raster.opened_and_closed(255 - dust)[2:4, 2:4] == 0).all()
    ring = np.array([[0, 0], [5, 0], [10, 0], [10, 5], [10, 10], [0, 10]])
    assert raster.simplified(ring).tolist() == [[0, 0], [10, 0], [10, 10], [0, 10]]
    assert raster.icon_labels(picture, [[0, 0, 0], [200, 10, 10]])[[0, 10, 40], [0, 10, 40]].tolist() == [0, 1, 2]


class Service:
    """A service whose answers and clock are given."""

    def __init__(self, *answers):
        self.answers, self.clock, self.sent = list(answers), 0.0, []

    def client(self, **more):
        def send(service, model, payload):
            self.sent.append((self.clock, service, model))
            answer = self.answers.pop(0)
            if isinstance(answer, Exception):
                raise answer
            return vision.Response(*answer)

        def sleep(seconds):
            self.clock += seconds

        return vision.Client(send, lambda: self.clock, sleep, lambda: self.clock, **more)


def test_vision_requests():
    body = lambda **e: json.dumps({"error": e})
    s = Service((429, {"Retry-After": "7"}, ""), (503, {}, ""), (200, {}, "good"))
    assert s.client().post("g", "m", {}) == "good" and [round(t) for t, *_ in s.sent] == [0, 7, 13]
    s = Service((200, {}, "a"), (200, {}, "b"))
    client = s.client()
    client.post("g", "m", {})
    client.post("g", "n", {})
    assert s.sent[1][0] == 6.0  # ten a minute
    for answer, scope in (((401, {}, ""), "g"), ((404, {}, ""), ("g", "m")), ((429, {}, body(details=[{"violations": [{"quotaId": "PerDay"}]}])), "g"), ((429, {}, body(details=[{"violations": [{"quotaValue": "0", "quotaDimensions": {"model": "m"}}]}])), ("g", "m"))):
        client = Service(answer).client()
        with pytest.raises(vision.Unavailable):
            client.post("g", "m", {})
        assert list(client.disabled) == [scope]
        with pytest.raises(vision.Unavailable):
            client.post("g", "m", {})  # nothing is sent
    client = Service((429, {"Retry-After": "500"}, "")).client()
    with pytest.raises(vision.Unavailable, match="no retries"):
        client.post("g", "m", {})  # longer than the budget: no wait
    assert client.cooldown["g"] == 500
    s = Service(OSError("secret address"), OSError(), OSError(), (200, {}, '{"title": "x"}'))
    found, errors = s.client().first_answer([("g", ["m"]), ("o", ["n"])], {}, lambda service, text: json.loads(text))
    assert found == {"title": "x", "source": "ai", "provider": "o:n"} and errors == ["g/m: OSError: no retries left"]
    assert vision.retry_delay(vision.Response(429, {}, body(details=[{"retryDelay": {"seconds": 3, "nanos": 5e8}}, {"retryDelay": "2s"}], message="Retry in 1.5 s")), 9, 0) == 3.5
    assert [vision.retry_delay(None, k, 0) for k in (0, 3, 9)] == [1, 8, 60]


def test_settings_and_workspace(tmp_path):
    of = lambda **k: settings.Settings(**k).error()
    assert of() is None and of(kind="icon") is None and of(grid="3X5") is None and of(target=65) is None
    assert all(of(**k) for k in ({"workers": 0}, {"grid": "4"}, {"grid": "0x4"}, {"kind": "photo"}, {"target": 14}, {"target": 17, "kind": "icon"}, {"target": float("nan")}))
    with settings.workspace(str(tmp_path)), pytest.raises(RuntimeError, match="another"), settings.workspace(str(tmp_path)):
        pass
    times = {}
    with pytest.raises(KeyError), settings.timed(times, "a"):
        raise KeyError
    assert times["a"] >= 0


def test_scans_and_sinks_of_files(spark, tmp_path):
    for name in ("output/in/b/z.png", "output/in/b-c.JPG", "output/in/x/out/d.webp", "output/in/t.txt", "output/in/outer/e.jpeg"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(name.encode())
    root = str(tmp_path / "output" / "in")
    got = tables.read_images(spark, root, (f"{root}/x/out", f"{root}/out", root)).orderBy("parts").collect()
    assert [r.path.split("/in/")[1] for r in got] == ["b/z.png", "b-c.JPG", "outer/e.jpeg"]
    path = str(tmp_path / "m.csv")
    df = spark.createDataFrame([("b.svg", 'say "x"', "k, l"), ("a.svg", "", None)], "Filename string, Title string, Keywords string")
    for _ in range(2):
        tables.write_csv(df, path, "Filename")
    assert (tmp_path / "m.csv").read_bytes() == b'Filename,Title,Keywords\r\na.svg,,\r\nb.svg,"say ""x""","k, l"\r\n'
    (tmp_path / "manual.csv").write_text('Filename,Title,Keywords\na.svg, A  b ,"one,Two,two,three,four,five"\n')
    row = tables.read_manual(spark, str(tmp_path / "manual.csv")).first()
    assert (row.title, row.keywords, row.category, row.source) == ("A b", ["one", "two", "three", "four", "five"], "", "manual")
    (tmp_path / "j").mkdir()
    tables.write_json(spark.createDataFrame([(1, 2.5)], "a long, b double"), str(tmp_path / "j" / "x"))
    assert tables.read_json(spark, str(tmp_path / "j" / "x"), "a long, b double").first() == (1, 2.5)
    with pytest.raises(Exception, match="finite"):
        tables.write_json(spark.createDataFrame([(1, float("nan"))], "a long, b double"), str(tmp_path / "j" / "y"))
    log = upsert.with_known_fields(spark.createDataFrame([("x", "f.svg")], "own string, filename string"))
    assert log.columns == [*upsert.LOG_FIELDS, "own"] and log.first().niche == ""


def test_quantiles_and_palettes(spark):
    rng = np.random.default_rng(4)
    data = [(k, float(v)) for k in range(3) for v in rng.normal(0, 10**k, 400).round(k)] + [(7, 1.5), (8, None), (9, 2.0), (9, 2.0), (9, 4.0)]
    got = dict(map(tuple, pixels.quantile(spark.createDataFrame(data, "k int, v double"), "k", "v", 0.95, Scratch(spark, "t"), bins=8).collect()))
    want = {k: float(np.quantile([v for j, v in data if j == k], 0.95)) for k in (0, 1, 2, 7, 9)}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    buckets = [("a", 0, 0, 0, 5, 1.0, 1.0, 1.0), ("a", 1, 1, 1, 9, 7.0, 7.0, 7.0), ("a", 9, 9, 9, 5, 75.0, 75.0, 75.0), ("b", 0, 0, 0, 1, 0.0, 0.0, 0.0)]
    df = spark.createDataFrame(buckets, "asset_id string, br int, bg int, bb int, pixels long, r double, g double, b double")
    out = pixels.greedy_palette(df).orderBy("asset_id", "rank")
    assert [(r.asset_id, r.pixels) for r in out.collect()] == [("a", 14), ("a", 5), ("b", 1)]
    assert pixels.significant(out, F.lit(1_000_000.0)).count() == 2


def test_artboards_and_status_tables(spark):
    value = lambda c: spark.range(1).select(c).first()[0]
    board = lambda w, h, *more: tuple(value(paths.artboard(F.lit(float(w)), F.lit(float(h)), *more)))
    assert board(3, 7, 15.0) == (2536, 5916, None) and board(1, 2000) == (None, None, "aspect") and board(1, 90, 16.0, "icon") == (None, None, "sides")
    with pytest.raises(ValueError):
        board(1, 1, 70.0)
    old = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, v string")
    new = spark.createDataFrame([("b", "1", 1, "e"), ("b", "2", 2, "e"), ("c", "3", 1, "e")], "k string, v string, seq int, extra string")
    assert sorted((r.k, r.v, r.extra) for r in upsert.put_latest(old, new, "k", "seq").collect()) == [("a", "x", None), ("b", "2", "e"), ("c", "3", "e")]
    assert [r.v for r in upsert.absent(old, new, "k", "seq").collect()] == ["3"]
    assert assets.newest(spark.createDataFrame([("x",)], "name string")).count() == 0
