"""A tiny invented league as raw documents of both providers."""

import itertools
import json
import os
import random

SEASON, LEAGUE, TEAMS, SQUAD = "2526", "la_liga", 6, 14
SHAPE = [("Goalkeeper", "", "G"), ("Defender", "Left", "D"), ("Defender", "Centre", "D"), ("Defender", "Centre", "D"),
         ("Defender", "Right", "D"), ("Midfielder", "Centre", "M"), ("Midfielder", "Left/Centre", "M"),
         ("Midfielder", "Centre/Right", "M"), ("Striker", "Left/Centre", "F"), ("Striker", "Centre", "F"),
         ("Striker", "Centre/Right", "F")]
FORMATION_433 = {"Goalkeeper": "GK", "Defender Left": "LB", "Defender Centre": "CB", "Defender Right": "RB",
                 "Midfielder Centre": "DM", "Midfielder Left/Centre": "AM", "Midfielder Centre/Right": "AM",
                 "Striker Left/Centre": "LW", "Striker Centre": "ST", "Striker Centre/Right": "RW"}
SLOTS = {"4-3-3": {"GK": 1, "RB": 1, "CB": 2, "LB": 1, "DM": 1, "AM": 2, "LW": 1, "RW": 1, "ST": 1}}
COORDS = {"4-3-3": {"GK": [[5, 50]], "RB": [20, 10], "CB": [[20, 35], [20, 65]], "LB": [20, 90], "DM": [40, 50],
                    "AM": [[50, 30], [50, 70]], "LW": [70, 80], "RW": [70, 20], "ST": [80, 50]}}
CITY = ["Norvale", "Estoria", "Quinta", "Brumal", "Zephyra", "Halden"]
FIRST = ["Aldo", "Bruno", "Ciro", "Dario", "Émile", "Fabio", "Göran", "Hugo", "Ivo", "Jonas", "Karl", "Luca", "Milo", "Nuno"]
LAST = ["Abela", "Bordón", "Crispin", "Dvorak", "Eklund", "Ferreira", "Grimaldi", "Holm", "Ibarra", "Jansen", "Kovač",
        "Lindqvist", "Moretti", "Nakata", "Olsen", "Petrov", "Quaresma", "Rossi", "Sandoval", "Takács"]


def dump(path, obj):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(obj if isinstance(obj, str) else json.dumps(obj, ensure_ascii=False))


def build(root):
    rnd = random.Random(7)
    comp = f"{root}/competitions/{LEAGUE}/{SEASON}"
    people = {}
    for t in range(TEAMS):
        dump(f"{root}/entities/team/{100 + t}.json", {"team": {
            "id": 100 + t, "name": f"FC {CITY[t]}", "shortName": CITY[t], "fullName": f"Football Club {CITY[t]}",
            "manager": {"id": 900 + t}, "country": {"name": "Spain" if t % 2 else "Italy"},
            "foundationDateTimestamp": -1500000000 + t, "teamColors": {"primary": "#ffffff" if t == 0 else "#112233", "secondary": "#445566"}}})
        dump(f"{root}/entities/manager/{900 + t}.json", {"manager": {
            "id": 900 + t, "name": f"Coach {LAST[t]}", "shortName": f"C. {LAST[t]}", "country": {"name": "Spain"},
            "dateOfBirthTimestamp": 86400 * 1000, "performance": {"total": 10, "wins": 5}}})
        people[t] = []
        for p in range(SQUAD):
            pid = 1000 + t * 100 + p
            first, last = FIRST[(p + 3 * t) % len(FIRST)], LAST[(p * 3 + 5 * t) % len(LAST)]
            shape = SHAPE[p % len(SHAPE)]
            people[t].append((pid, first, last, shape))
            dump(f"{root}/entities/player/{pid}.json", {"player": {
                "id": pid, "name": f"{first} {last}", "shortName": f"{first[0]}. {last}", "team": {"id": 100 + t},
                "positionsDetailed": {"G": ["GK"], "D": ["DC", "DL"], "M": ["MC"], "F": ["ST", "LW"]}[shape[2]],
                "shirtNumber": p + 1, "height": 170 + p, "preferredFoot": "Left" if p % 3 else "Right",
                "dateOfBirthTimestamp": 86400 * 365 * (20 + p % 15), "country": {"name": "Spain" if p % 2 else "Italy"},
                "contractUntilTimestamp": 1900000000, "proposedMarketValue": 100000 * (p + 1)}})
    dump(f"{root}/entities/player/broken.json", '{"player": {"id": 1, ')
    dump(f"{root}/entities/player/9999.json", {"player": {"id": 9999, "name": "Lone Wolf"}})

    def person(t, p):
        pid, first, last, shape = people[t][p]
        return {"id": f"p{pid}", "type": "player", "firstName": first, "lastName": last, "shortFirstName": first,
                "shortLastName": last, "matchName": f"{first[0]}. {last}", "nationality": "Spain",
                "position": shape[0], "shirtNumber": p + 1}

    dump(f"{comp}/scoresway/squads.json", {"squad": [{
        "contestantId": f"t{t}", "contestantName": f"{CITY[t]} Football Club", "contestantShortName": CITY[t],
        "contestantClubName": CITY[t], "contestantCode": CITY[t][:3].upper(),
        "teamKits": {"kit": [{"type": "Home", "shirtColour1": "#00ff00"}, {"type": "Away", "shirtColour1": "#0000ff"}]},
        "person": [person(t, p) for p in range(SQUAD)] + [{
            "id": f"c{t}", "type": "coach", "firstName": "Coach", "lastName": LAST[t], "shortFirstName": "Coach",
            "shortLastName": LAST[t], "matchName": f"C. {LAST[t]}", "nationality": "Spain"}]} for t in range(TEAMS)]})

    calendar = []
    for m, (h, a) in enumerate(itertools.permutations(range(TEAMS), 2)):
        mid, day = 5000 + m, 1755302400 + m * 3 * 86400        # from 2025-08-16
        goals, lines = {}, {}
        for side, t in (("home", h), ("away", a)):
            rows, n_goals = [], 0
            for p in range(SQUAD):
                pid, first, last, shape = people[t][p]
                starter = p < 11
                passes, shots = rnd.randint(5, 60), rnd.randint(0, 4)
                g = 1 if starter and shape[2] == "F" and rnd.random() < 0.4 else 0
                n_goals += g
                st = {"minutesPlayed": 90 if starter else 0, "totalPass": passes if starter else 0,
                      "accuratePass": passes * 3 // 4 if starter else 0, "touches": passes + 20 if starter else 0,
                      "goals": g, "totalShots": max(shots, g) if starter else 0, "onTargetScoringAttempt": g,
                      "totalTackle": rnd.randint(0, 5) if starter else 0, "wonTackle": 1 if starter else 0,
                      "interceptionWon": rnd.randint(0, 4) if starter else 0, "duelWon": rnd.randint(0, 6) if starter else 0,
                      "duelLost": rnd.randint(1, 6) if starter else 0, "expectedGoals": g * 0.5, "keyPass": rnd.randint(0, 2) if starter else 0,
                      "captain": True, "ratingVersions": {"original": 7}}
                rows.append((p, pid, shape, st))
            goals[side], lines[side] = n_goals, rows
        base = f"{comp}/sofascore/matches/{mid}"
        dump(f"{base}/info.json", {"event": {
            "id": mid, "roundInfo": {"round": m // 3}, "winnerCode": 1, "venue": {"id": 1},
            "homeTeam": {"id": 100 + h, "manager": {"id": 900 + h}}, "awayTeam": {"id": 100 + a, "manager": {"id": 900 + a}},
            "homeScore": {"display": goals["home"]} if m else {}, "awayScore": {"display": goals["away"]}, "startTimestamp": day + 72000}})
        dump(f"{base}/stats.json", {"statistics": [{"groups": [{"statisticsItems": [
            {"key": "ballPossession", "homeValue": 55.0, "awayValue": 45.0}, {"key": "fouls", "homeValue": 9, "awayValue": 11},
            {"key": "cornerKicks", "homeValue": 4, "awayValue": 2}]}]}]})
        dump(f"{base}/lineups.json", {side: {"formation": "4-3-3", "players": [{
            "player": {"id": pid}, "shirtNumber": str(p + 1), "position": shape[2], "statistics": st}
            for p, pid, shape, st in lines[side]]} for side in ("home", "away")})
        sw = f"m{mid}"
        calendar.append({"matchInfo": {"id": sw, "date": f"2025-{8 + (15 + m * 3) // 31:02d}-{(15 + m * 3) % 28 + 1:02d}Z",
                                       "time": None if m % 5 == 0 else "20:00:00Z",
                                       "contestant": [{"id": f"t{h}"}, {"id": f"t{a}"}]}})
        dump(f"{comp}/scoresway/matches/{sw}.json", {"liveData": {"lineUp": [{
            "averageAge": 25.5 + t, "teamOfficial": [{"id": f"c{t}"}], "player": [{
                "playerId": f"p{pid}", "shirtNumber": p + 1, "position": shape[0] if p < 11 else "Substitute",
                "positionSide": shape[1], "stat": [{"type": "goals", "value": str(st["goals"])}, {"type": "gameStarted", "value": "1"},
                                                   {"type": "goalsConceded", "value": str(goals["away" if side == "home" else "home"])},
                                                   {"type": "minsPlayed", "value": str(st["minutesPlayed"])}]}
                for p, pid, shape, st in lines[side]]} for side, t in (("home", h), ("away", a))]}})
        feed = [{"id": 1, "typeId": 32, "contestantId": f"t{h}"}]
        for e in range(60):
            t = h if e % 2 else a
            pid = people[t][rnd.randrange(11)][0]
            kind = rnd.choice([1, 1, 1, 1, 13, 15, 16, 7])
            quals = [{"qualifierId": 56, "value": rnd.choice(["Back", "Center", "Left", "Right"])}]
            if kind == 1:
                quals += [{"qualifierId": 140, "value": str(rnd.randint(0, 100))}, {"qualifierId": 141, "value": str(rnd.randint(0, 100))},
                          {"qualifierId": 212, "value": "10.5"}, {"qualifierId": 213, "value": "1.5"}]
            elif kind != 7:
                quals += [{"qualifierId": 102, "value": "51.2"}, {"qualifierId": 103, "value": "10"}]
            feed.append({"id": e + 2, "typeId": kind, "periodId": 1, "timeMin": e, "timeSec": 0, "contestantId": f"t{t}",
                         "playerId": f"p{pid}", "outcome": rnd.choice([0, 1, 1]), "x": rnd.randint(0, 100), "y": rnd.randint(0, 100),
                         "qualifier": quals})
        feed.append({"id": 99, "typeId": 1, "contestantId": f"t{h}"})          # no player
        dump(f"{root}/eventing/{sw}.json", {"liveData": {"event": feed}})
    dump(f"{comp}/scoresway/matches.json", {"match": calendar + [{"matchInfo": {
        "id": "future", "date": "2031-01-01Z", "time": "", "contestant": [{"id": "t0"}, {"id": "t1"}]}}]})
    dump(f"{root}/lookups/formations/4_3_3.json", FORMATION_433)
    dump(f"{root}/lookups/slots.json", SLOTS)
    dump(f"{root}/lookups/coords.json", COORDS)
    return root
