"""Hand-made landed documents with the edge cases of the flat tables."""

from __future__ import annotations

import json


def artist_ref(name: str) -> dict:
    return {
        "href": f"h/{name}", "id": name, "name": name.upper(), "type": "artist", "uri": f"u:{name}",
    }


def track(
    track_id: str,
    day: str | None,
    position: int | None,
    artists=("a1",),
    markets=("BR", "US"),
) -> dict:
    return {
        "album": {
            "album_type": "single", "href": "h/al", "id": "al1", "name": "Album",
            "release_date": "2022", "total_tracks": 3, "uri": "u:al1",
        },
        "artists": None if artists is None else [artist_ref(a) for a in artists],
        "available_markets": None if markets is None else list(markets),
        "date_ranking": day,
        "disc_number": 1,
        "duration_ms": 1000,
        "explicit": False,
        "external_ids": {"isrc": f"I{track_id}"},
        "external_urls": {"spotify": f"s/{track_id}"},
        "href": f"h/{track_id}",
        "id": track_id,
        "is_local": False,
        "name": f"Track {track_id}",
        "popularity": 50,
        "position": position,
        "preview_url": None,
        "track_number": 1,
        "type": "track",
        "uri": f"u:{track_id}",
    }


TRACKS = [
    track("t1", "2022-04-01", 1),
    track("t2", "2022-04-01", 2, artists=("a1", "a2")),
    track("t3", "2022-04-01", 3, markets=()),
    track("t4", "2022-04-01", 4, artists=()),
    track("t1", "2022-04-02", 1),  # the same track at the same place on another day
    track("t5", "2022-13-40", 2),  # no such day
    track("t6", "2022-04-02", None),
    track("t7", "2022-04-02", 3),
    track("t7", "2022-04-02", 3),  # twice in one batch
    track("t8", "2022-04-02", 4, markets=None),
]


def artist(artist_id: str, total: int, genres, sizes=(64, 300)) -> dict:
    return {
        "external_urls": {"spotify": f"s/{artist_id}"},
        "followers": {"total": total},
        "genres": genres,
        "href": f"h/{artist_id}",
        "id": artist_id,
        "images": [{"height": s, "url": f"i/{artist_id}/{s}", "width": s} for s in sizes],
        "name": artist_id.upper(),
        "popularity": 10,
        "type": "artist",
        "uri": f"u:{artist_id}",
    }


ARTISTS = [
    artist("a1", 100, ["pop", "rock"]),
    artist("a1", 120, ["pop"]),  # another follower total
    artist("a2", 7, ["samba"], sizes=(64,)),
    artist("a3", 1, None),
    artist("a4", 2, ["pop"], sizes=()),
]

FEATURES = [
    {"id": "t1", "tempo": 120.5, "duration_ms": 1000, "mode": 1, "unlisted": "x"},
    {"id": "t2", "tempo": "fast", "duration_ms": 2000},
    {"id": "t7", "energy": 0.25},
]


def write_lines(folder, documents) -> str:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "part.json").write_text("".join(json.dumps(d) + "\n" for d in documents))
    return str(folder)


def write_one_per_file(folder, documents) -> str:
    folder.mkdir(parents=True, exist_ok=True)
    for i, d in enumerate(documents):
        (folder / f"{i}.json").write_text(json.dumps(d, indent=2))
    return str(folder)
