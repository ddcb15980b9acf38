"""Metric catalogue.

Fixed values: each line is ``name = formula`` in catalogue order.  A formula
with a ``/`` is the null-safe ratio rounded to four places, the others are
plain sums or differences.  A later line may use a metric of an earlier one.
"""

PLAYER_METRICS = """
PassAccuracy = AccuratePasses / Passes
OwnHalfPassAccuracy = AccurateOwnHalfPasses / OwnHalfPasses
OppositionHalfPassAccuracy = AccurateOppositionHalfPasses / OppositionHalfPasses
LongBallAccuracy = AccurateLongBalls / LongBalls
OwnHalfPassShare = OwnHalfPasses / Passes
OppositionHalfPassShare = OppositionHalfPasses / Passes
LongBallShare = LongBalls / Passes
ProgressiveFieldTilt = OppositionHalfPasses / (OppositionHalfPasses + OwnHalfPasses)
PassesPerTouch = Passes / Touches
TouchesPerPass = Touches / Passes
PossessionLossRate = PossessionLost / Touches
UnsuccessfulTouchRate = UnsuccessfulTouches / Touches
DispossessedRate = Dispossessed / Touches
KeyPassesPerPass = KeyPasses / Passes
AssistConversion = GoalAssists / KeyPasses
ExpectedAssistsPerKeyPass = ExpectedAssists / KeyPasses
ExpectedAssistsPerPass = ExpectedAssists / Passes
CrossAccuracy = AccurateCrosses / Crosses
CrossShare = Crosses / Passes
AccurateCrossShare = AccurateCrosses / Passes
BigChancesPerKeyPass = BigChancesCreated / KeyPasses
PassPercZoneBack = PassAccZoneBack / PassZoneBack
PassPercZoneCenter = PassAccZoneCenter / PassZoneCenter
PassPercZoneLeft = PassAccZoneLeft / PassZoneLeft
PassPercZoneRight = PassAccZoneRight / PassZoneRight
PassShareZoneBack = PassZoneBack / (PassZoneBack + PassZoneCenter + PassZoneLeft + PassZoneRight)
PassShareZoneCenter = PassZoneCenter / (PassZoneBack + PassZoneCenter + PassZoneLeft + PassZoneRight)
PassShareZoneLeft = PassZoneLeft / (PassZoneBack + PassZoneCenter + PassZoneLeft + PassZoneRight)
PassShareZoneRight = PassZoneRight / (PassZoneBack + PassZoneCenter + PassZoneLeft + PassZoneRight)
PassPercDirBackward = PassAccDirBackward / PassDirBackward
PassPercDirBackwardLeft = PassAccDirBackwardLeft / PassDirBackwardLeft
PassPercDirBackwardRight = PassAccDirBackwardRight / PassDirBackwardRight
PassPercDirForward = PassAccDirForward / PassDirForward
PassPercDirForwardLeft = PassAccDirForwardLeft / PassDirForwardLeft
PassPercDirForwardRight = PassAccDirForwardRight / PassDirForwardRight
PassPercDirLeft = PassAccDirLeft / PassDirLeft
PassPercDirRight = PassAccDirRight / PassDirRight
PassShareDirBackward = PassDirBackward / (PassDirBackward + PassDirBackwardLeft + PassDirBackwardRight + PassDirForward + PassDirForwardLeft + PassDirForwardRight + PassDirLeft + PassDirRight)
PassShareDirBackwardLeft = PassDirBackwardLeft / (PassDirBackward + PassDirBackwardLeft + PassDirBackwardRight + PassDirForward + PassDirForwardLeft + PassDirForwardRight + PassDirLeft + PassDirRight)
PassShareDirBackwardRight = PassDirBackwardRight / (PassDirBackward + PassDirBackwardLeft + PassDirBackwardRight + PassDirForward + PassDirForwardLeft + PassDirForwardRight + PassDirLeft + PassDirRight)
PassShareDirForward = PassDirForward / (PassDirBackward + PassDirBackwardLeft + PassDirBackwardRight + PassDirForward + PassDirForwardLeft + PassDirForwardRight + PassDirLeft + PassDirRight)
PassShareDirForwardLeft = PassDirForwardLeft / (PassDirBackward + PassDirBackwardLeft + PassDirBackwardRight + PassDirForward + PassDirForwardLeft + PassDirForwardRight + PassDirLeft + PassDirRight)
PassShareDirForwardRight = PassDirForwardRight / (PassDirBackward + PassDirBackwardLeft + PassDirBackwardRight + PassDirForward + PassDirForwardLeft + PassDirForwardRight + PassDirLeft + PassDirRight)
PassShareDirLeft = PassDirLeft / (PassDirBackward + PassDirBackwardLeft + PassDirBackwardRight + PassDirForward + PassDirForwardLeft + PassDirForwardRight + PassDirLeft + PassDirRight)
PassShareDirRight = PassDirRight / (PassDirBackward + PassDirBackwardLeft + PassDirBackwardRight + PassDirForward + PassDirForwardLeft + PassDirForwardRight + PassDirLeft + PassDirRight)
ShotAccuracy = ShotsOnTarget / TotalShots
GoalConversion = Goals / TotalShots
BigChanceMissRate = BigChancesMissed / BigChancesCreated
ExpectedGoalsPerShot = ExpectedGoals / TotalShots
ExpectedGoalsOnTargetPerShotOnTarget = ExpectedGoalsOnTarget / ShotsOnTarget
GoalsMinusxG = Goals - ExpectedGoals
GoalsMinusxGOT = Goals - ExpectedGoalsOnTarget
BlockedShotRate = BlockedShots / TotalShots
ShotsOnTargetRate = ShotsOnTarget / TotalShots
ShotsOffTargetRate = ShotsOffTarget / TotalShots
GoalsPerShotOnTarget = Goals / ShotsOnTarget
HitWoodworkRate = HitWoodwork / TotalShots
MissedShotRate = MissedShots / (MissedShots + ShotsOnPost + SavedShots)
PostShotRate = ShotsOnPost / (MissedShots + ShotsOnPost + SavedShots)
SavedShotRate = SavedShots / (MissedShots + ShotsOnPost + SavedShots)
DuelWinRate = DuelsWon / (DuelsWon + DuelsLost)
AerialWinRate = AerialWon / (AerialWon + AerialLost)
ContestWinRate = ContestsWon / Contests
ChallengesLostRate = ChallengesLost / Contests
DefensiveActions = Tackles + Interceptions + Clearances + OutfielderBlocks
DefensiveActionSuccess = (TacklesWon + Interceptions + Clearances) / DefensiveActions
TackleAccuracy = TacklesWon / Tackles
InterceptionShare = Interceptions / DefensiveActions
ClearanceShare = Clearances / DefensiveActions
BlockShare = OutfielderBlocks / DefensiveActions
BallRecoveryRate = BallRecoveries / DefensiveActions
LastManTackleRate = LastManTackles / Tackles
ClearanceOffLineRate = ClearanceOffLine / Clearances
ErrorsLeadToShotRate = ErrorsLeadToShot / DefensiveActions
ErrorsLeadToGoalRate = ErrorsLeadToGoal / DefensiveActions
GoalsConcededPerDefAction = GoalsConceded / DefensiveActions
SaveRate = Saves / (Saves + GoalsConceded)
SavedShotsInsideBoxRate = SavedShotsInsideBox / Saves
CrossesNotClaimedRate = CrossesNotClaimed / (CrossesNotClaimed + HighClaims)
HighClaimRate = HighClaims / (HighClaims + Punches + CrossesNotClaimed)
PunchRate = Punches / (HighClaims + Punches + CrossesNotClaimed)
KeeperSweeperAccuracy = AccurateKeeperSweeperActions / KeeperSweeperActions
PenaltySaveRate = PenaltySaves / PenaltyFaced
PenaltyGoalConcededRate = PenaltyGoalsConceded / PenaltyFaced
GoalsPreventedDiff = GoalsPrevented - GoalsConceded
CardsPerFoul = (YellowCards + RedCards) / Fouls
YellowCardsPerFoul = YellowCards / Fouls
RedCardsPerFoul = RedCards / Fouls
FoulsPerDefAction = Fouls / DefensiveActions
WasFouledRate = WasFouled / Touches
OffsideRate = Offsides / TotalShots
CornersWonRate = CornersWon / Touches
CornersLostRate = CornersLost / DefensiveActions
CornersTakenRate = CornersTaken / Touches
GoalKicksRate = GoalKicks / Touches
PenaltyWonRate = PenaltyWon / Touches
PenaltyMissRate = PenaltyMissed / PenaltyWon
PenaltyConcededRate = PenaltyConceded / DefensiveActions
GoalsMinusGoalsConceded = Goals - GoalsConceded
ShotsMinusGoals = TotalShots - Goals
OwnGoalRate = OwnGoals / GoalsConceded
"""

TEAM_METRICS = """
ShotAccuracy = ShotsOnTarget / TotalShots
GoalConversion = Goals / TotalShots
BigChanceConversion = BigChanceScored / BigChanceCreated
BigChanceMissRate = BigChanceMissed / BigChanceCreated
ExpectedGoalsPerShot = ExpectedGoals / TotalShots
ExpectedGoalsOnTargetPerShotOnTarget = ExpectedGoalsOnTarget / ShotsOnTarget
GoalsMinusxG = Goals - ExpectedGoals
GoalsMinusxGOT = Goals - ExpectedGoalsOnTarget
ShotsInsideBoxRate = TotalShotsInsideBox / TotalShots
ShotsOutsideBoxRate = TotalShotsOutsideBox / TotalShots
BlockedShotRate = BlockedShots / TotalShots
ShotsOnTargetRate = ShotsOnTarget / TotalShots
ShotsOffTargetRate = ShotsOffTarget / TotalShots
BigChanceRate = BigChanceCreated / TotalShots
GoalsPerShotOnTarget = Goals / ShotsOnTarget
HitWoodworkRate = HitWoodwork / TotalShots
FinalThirdEfficiency = BigChanceCreated / FinalThirdEntries
TouchesInOppBoxPerFinalThirdEntry = TouchesInOppBox / FinalThirdEntries
KeyPassesPerFinalThirdEntry = KeyPasses / FinalThirdEntries
KeyPassesPerShot = KeyPasses / TotalShots
AssistConversion = GoalAssists / KeyPasses
ExpectedAssistsPerKeyPass = ExpectedAssists / KeyPasses
ExpectedAssistsPerPass = ExpectedAssists / Passes
CrossAccuracy = AccurateCrosses / Crosses
CrossShare = Crosses / Passes
AccurateCrossShare = AccurateCrosses / Passes
ThroughBallAccuracy = AccurateThroughBall / Passes
BigChancesPerKeyPass = BigChanceCreated / KeyPasses
ShotsPerTouchInOppBox = TotalShots / TouchesInOppBox
GoalsPerTouchInOppBox = Goals / TouchesInOppBox
PassAccuracy = AccuratePasses / Passes
OwnHalfPassAccuracy = AccurateOwnHalfPasses / OwnHalfPasses
OppositionHalfPassAccuracy = AccurateOppositionHalfPasses / OppositionHalfPasses
LongBallAccuracy = AccurateLongBalls / LongBalls
OwnHalfPassShare = OwnHalfPasses / Passes
OppositionHalfPassShare = OppositionHalfPasses / Passes
LongBallShare = LongBalls / Passes
ProgressiveFieldTilt = OppositionHalfPasses / (OppositionHalfPasses + OwnHalfPasses)
PassesPerTouch = Passes / Touches
TouchesPerPass = Touches / Passes
PossessionLossRate = PossessionLost / Touches
UnsuccessfulTouchRate = UnsuccessfulTouches / Touches
DispossessedRate = Dispossessed / Touches
BallPossessionPerPass = BallPossession / Passes
FinalThirdEntriesPerPass = FinalThirdEntries / Passes
FinalThirdEntriesPerTouch = FinalThirdEntries / Touches
DefensiveActions = Tackles + Interceptions + Clearances + OutfielderBlocks
DefensiveActionSuccess = (TacklesWon + Interceptions + Clearances) / DefensiveActions
TackleAccuracy = TacklesWon / Tackles
InterceptionShare = Interceptions / DefensiveActions
ClearanceShare = Clearances / DefensiveActions
BlockShare = OutfielderBlocks / DefensiveActions
BallRecoveryRate = BallRecoveries / DefensiveActions
LastManTackleRate = LastManTackles / Tackles
ClearanceOffLineRate = ClearanceOffLine / Clearances
ErrorsLeadToShotRate = ErrorsLeadToShot / DefensiveActions
ErrorsLeadToGoalRate = ErrorsLeadToGoal / DefensiveActions
GoalsConcededPerDefAction = GoalsConceded / DefensiveActions
DuelWinRate = DuelsWon / (DuelsWon + DuelsLost)
AerialWinRate = AerialWon / (AerialWon + AerialLost)
ContestWinRate = ContestsWon / Contests
ChallengesLostRate = ChallengesLost / Contests
SaveRate = Saves / (Saves + GoalsConceded)
DiveSaveRate = DiveSaves / Saves
SavedShotsInsideBoxRate = SavedShotsInsideBox / Saves
CrossesNotClaimedRate = CrossesNotClaimed / (CrossesNotClaimed + HighClaims)
HighClaimRate = HighClaims / (HighClaims + Punches + CrossesNotClaimed)
PunchRate = Punches / (HighClaims + Punches + CrossesNotClaimed)
KeeperSweeperAccuracy = AccurateKeeperSweeperActions / KeeperSweeperActions
PenaltySaveRate = PenaltySaves / PenaltyFaced
PenaltyGoalConcededRate = PenaltyGoalsConceded / PenaltyFaced
GoalsPreventedDiff = GoalsPrevented - GoalsConceded
CardsPerFoul = (YellowCards + RedCards) / Fouls
YellowCardsPerFoul = YellowCards / Fouls
RedCardsPerFoul = RedCards / Fouls
FoulsPerDefAction = Fouls / DefensiveActions
WasFouledRate = WasFouled / Touches
FouledFinalThirdRate = FouledFinalThird / FinalThirdEntries
OffsideRate = Offsides / TotalShots
CornersWonRate = CornersWon / TotalShots
CornersLostRate = CornersLost / DefensiveActions
CornersTakenRate = CornersTaken / TotalShots
FreeKicksRate = FreeKicks / Touches
ThrowInsRate = ThrowIns / Touches
GoalKicksRate = GoalKicks / Touches
PenaltyWonRate = PenaltyWon / TouchesInOppBox
PenaltyMissRate = PenaltyMissed / PenaltyWon
PenaltyConcededRate = PenaltyConceded / DefensiveActions
GoalsMinusGoalsConceded = Goals - GoalsConceded
ShotsMinusGoals = TotalShots - Goals
BigChanceDelta = BigChanceCreated - BigChanceMissed
OwnGoalRate = OwnGoals / GoalsConceded
"""

# Means of a position on the pitch: averaged, never scaled to 90 minutes.
LOCATION_COLUMNS = [
    "PassMeanAngle", "PassMeanLength", "PassMeanX", "PassMeanY",
    "ShotMeanX", "ShotMeanY", "MeanGoalY", "MeanGoalZ", "ShotMeanLength",
    "GoalIniX", "GoalIniY", "GoalFinalY", "GoalFinalZ", "GoalMeanLength",
]


def parse(block):
    """Split a catalogue block into (name, numerator, denominator or None)."""
    rows = []
    for line in block.strip().splitlines():
        name, formula = line.split(" = ")
        num, _, den = formula.partition(" / ")
        rows.append((name, num, den or None))
    return rows
