"""Image jobs on generated PNG files."""

import numpy as np
import pandas as pd
import pytest
from png import write_png
from pyspark.sql import functions as F

from reelgrain.operators import images as im
from reelgrain.sources.objects import frame_listing, read_images


@pytest.fixture(scope="module")
def frames(tmp_path_factory):
    root = tmp_path_factory.mktemp("frames")
    rng = np.random.default_rng(1)
    pictures = {}
    for video in ("v1", "v2"):
        (root / video).mkdir()
        for i in range(3):
            pixels = rng.integers(0, 256, size=(20 + i, 30, 3), dtype=np.uint8)
            write_png(root / video / f"frame_{i:06d}.png", pixels)
            pictures[f"{video}/frame_{i:06d}.png"] = pixels
    (root / "v1" / "notes.txt").write_text("x")
    (root / "v1" / "broken.png").write_bytes(b"not a png")
    return root, pictures


def test_images_are_read_as_bgr(spark, frames):
    root, pictures = frames
    rows = read_images(spark, str(root)).collect()
    assert len(rows) == 6
    for r in rows:
        want = next(v for k, v in pictures.items() if r.origin.endswith(k))
        got = np.frombuffer(r.data, np.uint8).reshape(r.height, r.width, 3)
        assert (got[:, :, ::-1] == want).all()


def test_frame_listing_has_the_video(spark, frames):
    rows = frame_listing(spark, str(frames[0])).groupBy("video_id").count().collect()
    assert {r.video_id: r["count"] for r in rows} == {"v1": 4, "v2": 3}


@pytest.mark.parametrize("method", ["nearest", "bilinear"])
def test_process_frames(spark, frames, tmp_path, method):
    root, pictures = frames
    target = im.process_frames(spark, str(root), str(tmp_path / "out"), 15, 10, method, run_id="r1")
    rows = spark.read.parquet(target).collect()
    assert len(rows) == 6 and {(r.width, r.height, r.run_id, len(r.data)) for r in rows} == {(15, 10, "r1", 450)}
    row = next(r for r in rows if r.origin.endswith("v1/frame_000000.png"))
    got = np.frombuffer(row.data, np.uint8).reshape(10, 15, 3)[:, :, ::-1].astype(float)
    source = pictures["v1/frame_000000.png"].astype(float)
    if method == "nearest":
        assert (got == source[::2, ::2]).all()
    else:
        # at half size a pixel is the mean of the four it covers
        want = (source[::2, ::2] + source[1::2, ::2] + source[::2, 1::2] + source[1::2, 1::2]) / 4
        assert np.abs(got - want).max() <= 0.5


def test_bilinear_against_a_plain_loop():
    rng = np.random.default_rng(2)
    pixels = rng.integers(0, 256, size=(7, 5, 1)).astype(np.uint8)
    got = im.scale_image(pixels, 9, 4, "bilinear")
    for y in range(4):
        for x in range(9):
            sy, sx = min(max((y + 0.5) * 7 / 4 - 0.5, 0), 6), min(max((x + 0.5) * 5 / 9 - 0.5, 0), 4)
            y0, x0 = int(sy), int(sx)
            y1, x1, fy, fx = min(y0 + 1, 6), min(x0 + 1, 4), sy - y0, sx - x0
            p = pixels[:, :, 0].astype(float)
            want = (p[y0, x0] * (1 - fx) + p[y0, x1] * fx) * (1 - fy) + (p[y1, x0] * (1 - fx) + p[y1, x1] * fx) * fy
            assert got[y, x, 0] == pytest.approx(want)


def test_full_frame_size(spark, frames):
    rows = im.resize(read_images(spark, str(frames[0]))).select("width", "height", F.length("data").alias("n")).collect()
    assert {tuple(r) for r in rows} == {(1024, 768, 1024 * 768 * 3)}


def test_model_input(spark, frames):
    rows = im.normalise_pixels(read_images(spark, str(frames[0])), 20, 16).where("origin LIKE '%v1/frame_000000.png'").collect()
    tensor = np.array(rows[0].tensor).reshape(3, 16, 16)
    source = frames[1]["v1/frame_000000.png"][2:18, 7:23].astype(float) / 255
    want = (source.transpose(2, 0, 1) - np.array([0.485, 0.456, 0.406])[:, None, None]) / np.array([0.229, 0.224, 0.225])[:, None, None]
    assert np.abs(tensor - want).max() < 1e-5


def test_injected_models(spark, frames):
    def factory():
        def run(batch: pd.DataFrame) -> pd.DataFrame:
            found = [[] if "v2" in o else [{"confidence": 0.5, "class_id": 1}] for o in batch["origin"]]
            return pd.DataFrame({"origin": batch["origin"], "detections": found})

        return run

    rows = im.infer(read_images(spark, str(frames[0])), factory, "origin STRING, detections ARRAY<STRUCT<confidence: FLOAT, class_id: INT>>")
    flat = im.explode_detections(rows, "detections", ["origin"]).collect()
    assert len(flat) == 6
    assert sum(r.class_id is None for r in flat) == 3
