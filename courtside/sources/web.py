"""The league's public statistics API as the ``fetch`` functions that sources and operators take; runs on the driver."""

from __future__ import annotations

import json
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass

from courtside.sources.throttle import Throttled

# The address, the headers it asks for, and the parameters of its endpoints.
BASE = "https://stats.nba.com/stats/"
REQUEST_HEADERS = {"User-Agent": "Mozilla/5.0", "Referer": "https://www.nba.com/", "Origin": "https://www.nba.com", "Accept": "application/json"}
TIMEOUT = 30
LEAGUE = "00"
GAME_LOG = {"Counter": 1000, "DateFrom": "", "DateTo": "", "Direction": "ASC", "LeagueID": LEAGUE, "PlayerOrTeam": "T", "Sorter": "DATE"}
PLAYER_STATS = {
    "College": "", "Conference": "", "Country": "", "DateFrom": "", "DateTo": "", "Division": "", "DraftPick": "", "DraftYear": "",
    "GameScope": "", "GameSegment": "", "Height": "", "LastNGames": 0, "LeagueID": LEAGUE, "Location": "", "Month": 0, "OpponentTeamID": 0,
    "Outcome": "", "PORound": 0, "PaceAdjust": "N", "Period": 0, "PlayerExperience": "", "PlayerPosition": "", "PlusMinus": "N", "Rank": "N",
    "SeasonSegment": "", "ShotClockRange": "", "StarterBench": "", "TeamID": 0, "VsConference": "", "VsDivision": "", "Weight": "",
}
TRACKING = {"PerMode": "Totals", "PlayerOrTeam": "Player"}


@dataclass
class Response:
    status_code: int
    body: bytes

    def json(self) -> dict:
        if self.status_code != 200:
            raise OSError(f"status {self.status_code}")
        return json.loads(self.body)


def urlopen(url: str, params: dict) -> Response:
    request = urllib.request.Request(f"{url}?{urllib.parse.urlencode(params)}", headers=REQUEST_HEADERS)
    try:
        with urllib.request.urlopen(request, timeout=TIMEOUT) as reply:
            return Response(reply.status, reply.read())
    except urllib.error.HTTPError as error:
        return Response(error.code, b"")


class League:
    """Requests to the API, spaced and retried by one Throttled."""

    def __init__(self, call: Callable[[str, dict], Response] = urlopen, **options) -> None:
        self.web = Throttled(lambda url, params: call(url, params), **options)

    def _get(self, endpoint: str, **params) -> dict:
        return self.web.get(BASE + endpoint, params=params).json()

    def schedule(self, season: str, season_type: str) -> dict:
        return self._get("leaguegamelog", **GAME_LOG, Season=season, SeasonType=season_type)

    def play_by_play(self, game_id: str) -> dict:
        return self._get("playbyplayv2", GameID=game_id, StartPeriod=0, EndPeriod=10)

    def names(self, season: str | None) -> dict:
        return self._get("commonallplayers", LeagueID=LEAGUE, Season=season, IsOnlyCurrentSeason=0)

    def features(self, season: str, season_type: str) -> Callable[[str], dict]:
        """A fetch by name: dash_base, dash_advanced or pt_<measure>, each followed by the scope."""
        from courtside.operators.features import TRACKING as MEASURES

        of_name = {m.lower(): m for m in MEASURES}

        def fetch(name: str) -> dict:
            kind, what = name.split("_")[:2]
            if kind == "dash":
                return self._get("leaguedashplayerstats", **PLAYER_STATS, Season=season, SeasonType=season_type, MeasureType=what.title(), PerMode="Per100Possessions" if what == "base" else "PerGame")
            return self._get("leaguedashptstats", **PLAYER_STATS, **TRACKING, Season=season, SeasonType=season_type, PtMeasureType=of_name[what])

        return fetch
