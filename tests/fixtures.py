"""Hand-written rows of the three raw sources."""

CARDIO_COLUMNS = "id int, age int, gender int, height int, weight double, ap_hi int, ap_lo int, cholesterol int, gluc int, smoke int, alco int, active int, cardio int"
CARDIO_ROWS = [
    (1, 18393, 2, 168, 62.0, 110, 80, 1, 1, 0, 0, 1, 0),
    (2, 20228, 1, 156, 85.0, 140, 90, 3, 1, 0, 0, 1, 1),
    (3, 18857, 1, 165, 64.0, 130, 70, 3, 1, 0, 0, 0, 1),
    (3, 18857, 1, 165, 64.0, 130, 70, 3, 1, 0, 0, 0, 1),   # duplicate key, same row
    (3, 18857, 1, 165, 65.0, 130, 70, 3, 1, 0, 0, 0, 1),   # duplicate key, other row
    (4, 17623, 2, 169, 82.0, 80, 100, 1, 1, 0, 0, 1, 1),   # systolic below diastolic
    (5, 3000, 3, 169, 82.0, 150, 100, 9, 1, 0, 0, 1, 1),   # age, gender, cholesterol
    (6, 17623, 2, 0, 82.0, 150, 100, 1, 1, 0, 0, 1, 1),    # height 0: height and bmi
    (None, 17623, 2, 169, 82.0, 150, 100, 1, 1, 0, 0, 1, 1),
    (None, 17623, 2, 169, 82.0, 150, 100, 1, 1, 0, 0, 1, 1),
    (7, 17623, 2, 120, 30.0, 70, 70, 1, 1, 0, 0, 1, 1),    # bounds that hold
    (8, 17623, 2, 119, 30.0, 69, 69, 1, 1, 0, 0, 1, 1),    # just outside
]
CDC_COLUMNS = (
    "HeartDiseaseorAttack string, HighBP string, HighChol string, CholCheck string, BMI string, Smoker string, Stroke string, "
    "PhysActivity string, Fruits string, Veggies string, HvyAlcoholConsump string, AnyHealthcare string, NoDocbcCost string, "
    "GenHlth string, MentHlth string, PhysHlth string, DiffWalk string, Sex string, Age string, Education string, Income string")


def cdc(target="0.0", bp="1.0", bmi="30.0", smoker="1.0", health="3.0", mental="5.0", sex="0.0", age="9.0", education="4.0"):
    return (target, bp, "1.0", "1.0", bmi, smoker, "0.0", "1.0", "0.0", "1.0", "0.0", "1.0", "0.0", health, mental, "0.0",
            "0.0", sex, age, education, "3.0")


CDC_ROWS = [
    cdc(), cdc(),                      # exact copies, both kept
    cdc(age="18 to 24", target="1.0"), cdc(age="80 or older", sex="1.0"), cdc(health=None, mental=None),
    cdc(age="14.0"), cdc(bmi="junk", sex="x", smoker=""), cdc(mental="31.0"), cdc(bp="YES"),
]
CLEVELAND_COLUMNS = (
    "age int, sex int, cp int, trestbps int, chol int, fbs int, restecg int, thalach int, exang int, oldpeak double, "
    "slope int, ca int, thal int, condition int")
CLEVELAND_ROWS = [
    (69, 1, 0, 160, 234, 1, 2, 131, 0, 0.1, 1, 1, 0, 0),
    (69, 0, 0, 140, 239, 0, 0, 151, 1, 1.8, 0, 2, 0, 2),
    (60, 0, 3, 150, 180, 0, 0, 171, 0, 0.9, 0, None, 1, 1),
    (60, 0, 3, 150, 180, 0, 0, 171, 0, 0.9, 0, None, 1, 1),  # exact copy: one survives
    (60, 0, 3, 150, 180, 0, 0, 171, 0, 0.9, 0, 4, 1, -1),    # vessels out of range, negative target
    (24, 1, 1, 120, 250, 0, 1, 200, 0, 10.0, 2, 0, 2, 0),
]


def raw(spark):
    from riskgraph import vocabulary as V

    return {
        V.CARDIO: spark.createDataFrame(CARDIO_ROWS, CARDIO_COLUMNS),
        V.CDC: spark.createDataFrame(CDC_ROWS, CDC_COLUMNS),
        V.CLEVELAND: spark.createDataFrame(CLEVELAND_ROWS, CLEVELAND_COLUMNS),
    }
