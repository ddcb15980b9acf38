"""Match-rating weights.

Fixed values per position: ``BOUNDS`` holds (metric, lo, hi), ``TERMS`` holds
(weight, metric).  Metrics without bounds enter as they are, nulls count 0.
"""

# Bounds of each metric by position.
BOUNDS = {
    "GK": [
        ("GoalsPrevented", -3, 3), ("SavedShotsInsideBox", 0, 12), ("CrossesNotClaimed", 0, 3),
        ("Punches", 0, 8), ("KeeperSweeperActions", 0, 8), ("PenaltySaveRate", 0, 1.2),
        ("PenaltyConceded", 0, 1.2), ("ErrorsLeadToShot", 0, 2), ("ErrorsLeadToGoal", 0, 1), ("Goals", 0, 3),
        ("GoalAssists", 0, 3), ("YellowCards", 0, 1.5), ("RedCards", 0, 1),
    ],
    "FB": [
        ("Interceptions", 0, 8), ("BallRecoveries", 0, 12), ("ProgressiveFieldTilt", 0, 10),
        ("KeyPasses", 0, 5), ("GoalAssists", 0, 3), ("Goals", 0, 3), ("YellowCards", 0, 1.5),
        ("RedCards", 0, 1), ("ErrorsLeadToGoal", 0, 2), ("OwnGoals", 0, 2),
    ],
    "CB": [
        ("Interceptions", 0, 8), ("Clearances", 0, 8), ("OutfielderBlocks", 0, 5), ("LastManTackles", 0, 2),
        ("ErrorsLeadToShot", 0, 2), ("ErrorsLeadToGoal", 0, 1), ("OwnGoals", 0, 2),
        ("ClearanceOffLine", 0, 2), ("Goals", 0, 3), ("GoalAssists", 0, 3), ("YellowCards", 0, 1.5),
        ("RedCards", 0, 1),
    ],
    "DM": [
        ("Interceptions", 0, 8), ("BallRecoveries", 0, 12), ("ProgressiveFieldTilt", 0, 10),
        ("KeyPasses", 0, 5), ("ExpectedAssists", 0, 1), ("Goals", 0, 3), ("GoalAssists", 0, 3),
        ("YellowCards", 0, 1.5), ("RedCards", 0, 1),
    ],
    "AM": [
        ("KeyPasses", 0, 5), ("ExpectedAssists", 0, 1), ("GoalAssists", 0, 3), ("BigChancesCreated", 0, 4),
        ("Goals", 0, 3), ("ExpectedGoals", 0, 1.5), ("ShotsOnTarget", 0, 5), ("BigChancesMissed", 0, 3),
        ("Touches", 0, 100), ("YellowCards", 0, 1.5), ("RedCards", 0, 1),
    ],
    "WG": [
        ("AccurateCrosses", 0, 8), ("Goals", 0, 3), ("GoalAssists", 0, 3), ("ExpectedGoals", 0, 1.5),
        ("ExpectedAssists", 0, 1.5), ("KeyPasses", 0, 5), ("BigChancesCreated", 0, 5),
        ("BallRecoveries", 0, 12), ("WasFouled", 0, 8), ("DefensiveActions", 0, 10), ("YellowCards", 0, 1.5),
        ("RedCards", 0, 1),
    ],
    "ST": [
        ("Goals", 0, 3), ("ExpectedGoalsOnTarget", 0, 2), ("BigChancesMissed", 0, 3), ("GoalAssists", 0, 3),
        ("KeyPasses", 0, 5), ("BigChancesCreated", 0, 4), ("BallRecoveries", 0, 8), ("WasFouled", 0, 6),
        ("HitWoodwork", 0, 2), ("Offsides", 0, 5), ("PenaltyMissed", 0, 1), ("YellowCards", 0, 1.5),
        ("RedCards", 0, 1),
    ],
}

# Weight of each metric by position.
TERMS = {
    "GK": [
        (0.75, "SaveRate"), (0.55, "GoalsPrevented"), (0.35, "SavedShotsInsideBox"), (0.45, "HighClaimRate"),
        (0.30, "KeeperSweeperAccuracy"), (0.20, "Punches"), (0.40, "PassAccuracy"),
        (0.25, "LongBallAccuracy"), (0.15, "KeeperSweeperActions"), (0.60, "PenaltySaveRate"),
        (0.30, "Goals"), (0.25, "GoalAssists"), (-0.40, "CrossesNotClaimed"), (-0.30, "PenaltyConceded"),
        (-0.60, "ErrorsLeadToShot"), (-1.20, "ErrorsLeadToGoal"), (-1.50, "YellowCards"),
        (-4.00, "RedCards"),
    ],
    "FB": [
        (0.48, "TackleAccuracy"), (0.32, "Interceptions"), (0.32, "DuelWinRate"), (0.28, "BallRecoveries"),
        (0.48, "PassAccuracy"), (0.40, "OppositionHalfPassAccuracy"), (0.32, "ProgressiveFieldTilt"),
        (0.40, "CrossAccuracy"), (0.32, "KeyPasses"), (0.28, "GoalAssists"), (0.40, "WasFouledRate"),
        (0.30, "Goals"), (-3.00, "ErrorsLeadToGoal"), (-2.00, "OwnGoals"), (-1.50, "YellowCards"),
        (-4.00, "RedCards"),
    ],
    "CB": [
        (0.48, "DuelWinRate"), (0.48, "AerialWinRate"), (0.32, "TackleAccuracy"), (0.32, "Interceptions"),
        (0.40, "Clearances"), (0.32, "OutfielderBlocks"), (0.28, "LastManTackles"), (0.48, "PassAccuracy"),
        (0.32, "LongBallAccuracy"), (0.20, "OwnHalfPassAccuracy"), (1.50, "ClearanceOffLine"),
        (0.30, "Goals"), (0.25, "GoalAssists"), (-1.50, "ErrorsLeadToShot"), (-4.00, "ErrorsLeadToGoal"),
        (-2.00, "OwnGoals"), (-1.50, "YellowCards"), (-4.00, "RedCards"),
    ],
    "DM": [
        (0.48, "Interceptions"), (0.40, "BallRecoveries"), (0.32, "TackleAccuracy"),
        (0.20, "DefensiveActionSuccess"), (0.48, "PassAccuracy"), (0.32, "OwnHalfPassAccuracy"),
        (-0.32, "PossessionLossRate"), (0.32, "ProgressiveFieldTilt"), (0.16, "LongBallAccuracy"),
        (0.32, "KeyPasses"), (0.28, "ExpectedAssists"), (0.24, "DuelWinRate"), (0.16, "AerialWinRate"),
        (0.30, "Goals"), (0.25, "GoalAssists"), (-1.50, "YellowCards"), (-4.00, "RedCards"),
    ],
    "AM": [
        (0.48, "KeyPasses"), (0.40, "ExpectedAssists"), (0.40, "GoalAssists"), (0.32, "BigChancesCreated"),
        (0.48, "Goals"), (0.32, "ExpectedGoals"), (0.24, "ShotsOnTarget"), (0.40, "PassAccuracy"),
        (0.32, "OppositionHalfPassAccuracy"), (-0.08, "PossessionLossRate"), (0.20, "Touches"),
        (0.20, "ContestWinRate"), (-0.16, "BigChancesMissed"), (-1.50, "YellowCards"), (-4.00, "RedCards"),
    ],
    "WG": [
        (0.48, "CrossAccuracy"), (0.40, "ContestWinRate"), (0.32, "AccurateCrosses"), (0.48, "Goals"),
        (0.40, "GoalAssists"), (0.32, "ExpectedGoals"), (0.32, "ExpectedAssists"), (0.20, "KeyPasses"),
        (0.32, "BallRecoveries"), (0.24, "WasFouled"), (0.24, "DefensiveActions"), (0.32, "PassAccuracy"),
        (-0.20, "PossessionLossRate"), (0.12, "OppositionHalfPassShare"), (1.00, "BigChancesCreated"),
        (-1.50, "YellowCards"), (-4.00, "RedCards"),
    ],
    "ST": [
        (0.64, "Goals"), (0.40, "ExpectedGoalsOnTarget"), (0.40, "ShotAccuracy"), (0.40, "AerialWinRate"),
        (0.32, "DuelWinRate"), (0.28, "ContestWinRate"), (0.40, "GoalAssists"), (0.24, "KeyPasses"),
        (0.16, "BigChancesCreated"), (0.20, "BallRecoveries"), (0.20, "WasFouled"), (0.50, "HitWoodwork"),
        (0.30, "PassAccuracy"), (-1.50, "BigChancesMissed"), (-0.50, "Offsides"), (-2.00, "PenaltyMissed"),
        (-1.50, "YellowCards"), (-4.00, "RedCards"),
    ],
}

# Weight of each compatibility measure in the fit score.
FIT_WEIGHTS = {
    "TeamsCorrelation": 1.0, "SquadsCorrelation": 1.0, "EloRatingDiff": 1.0,
    "StatsCorrelation": 1.0, "RatingDiff": 1.0, "SamePosCorrelation": 0.8,
    "PassesCorrelation": 0.8, "PotentialDiff": 0.7, "FormationsMatch": 0.3,
    "TournamentsMatch": 0.2, "CountryMatch": 0.2, "TimestampDiff": 0.1,
}


def position_weights():
    """{position: [(weight, metric, lo, hi)]}; lo and hi are None if unbounded."""
    out = {}
    for position, terms in TERMS.items():
        bounds = {metric: (float(lo), float(hi)) for metric, lo, hi in BOUNDS[position]}
        out[position] = [(float(w), metric, *bounds.get(metric, (None, None))) for w, metric in terms]
    return out
