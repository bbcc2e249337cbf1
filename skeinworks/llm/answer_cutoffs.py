"""Cutoffs of the label model as answer_calibration.calibrate chose them, with their curves.

From 2000 rows of the largest test table; curve: cutoff, precision at the class's share in the corpus, recall on the half that
chose; held_out and majority: precision and recall on the other half, of the model and of a plain majority of the votes.
"""

from __future__ import annotations

CALIBRATED = {
    "refusal": {
        "cutoff": 0.999443438,
        "held_out": (0.999, 1.0),
        "majority": (0.999, 1.0),
        "curve": [
            (3.13135604e-05, 0.532074832, 1.0),
            (0.00039770013, 0.534211335, 1.0),
            (0.0597046287, 0.970811438, 1.0),
            (0.915999764, 0.977947659, 1.0),
            (0.999443438, 0.985189571, 1.0),
            (0.999996361, 0.985161074, 0.998050682),
            (0.999999987, 0.991351504, 0.861598441),
            (1.0, 0.991132734, 0.840155945),
        ],
    },
    "copied_question": {
        "cutoff": 0.999801972,
        "held_out": (1.0, 1.0),
        "majority": (0.9865, 1.0),
        "curve": [
            (1.61444297e-07, 0.517284643, 1.0),
            (4.66310803e-07, 0.619780692, 1.0),
            (7.97329118e-07, 0.629900423, 1.0),
            (1.61429438e-06, 0.640356108, 1.0),
            (1.35478655e-05, 0.772931173, 1.0),
            (7.93255467e-05, 0.778127896, 1.0),
            (0.000478014195, 0.799632894, 1.0),
            (0.00399762583, 0.846417509, 1.0),
            (0.0229627374, 0.878543435, 1.0),
            (0.21791327, 0.885263501, 1.0),
            (0.700456895, 0.927846652, 1.0),
            (0.985565202, 0.942966245, 1.0),
            (0.999801972, 1.0, 1.0),
            (0.999998908, 1.0, 0.998976459),
            (0.999999963, 1.0, 0.945752303),
            (0.999999996, 1.0, 0.94370522),
            (1.0, 1.0, 0.892528147),
            (1.0, 1.0, 0.892528147),
        ],
    },
    "other_language": {
        "cutoff": 0.990201513,
        "held_out": (1.0, 0.9117),
        "majority": (1.0, 0.9117),
        "curve": [
            (0.990201513, 1.0, 0.922566372),
            (0.999999704, 1.0, 0.913716814),
            (0.999999997, 1.0, 0.849557522),
            (1.0, 1.0, 0.613938053),
            (1.0, 1.0, 0.51659292),
            (1.0, 1.0, 0.51659292),
        ],
    },
    "truncated_step": {
        "cutoff": 0.538056504,
        "held_out": (1.0, 0.9084),
        "majority": (1.0, 0.4963),
        "curve": [
            (0.00263955735, 0.782618554, 0.915924827),
            (0.0154886642, 0.87035098, 0.914935707),
            (0.538056504, 1.0, 0.908011869),
            (0.99419681, 1.0, 0.90702275),
            (0.99950598, 1.0, 0.511374876),
            (0.99991686, 1.0, 0.504451039),
        ],
    },
    "truncated_final": {
        "cutoff": 0.227403491,
        "held_out": (1.0, 1.0),
        "majority": (1.0, 0.0129),
        "curve": [
            (0.227403491, 1.0, 1.0),
            (0.642839541, 1.0, 0.514631685),
            (0.937105285, 1.0, 0.508577195),
        ],
    },
    "empty_answer": {
        "cutoff": 0.999487556,
        "held_out": (1.0, 0.9993),
        "majority": (1.0, 0.8145),
        "curve": [
            (0.115152141, 0.777905104, 1.0),
            (0.932077018, 0.920845802, 1.0),
            (0.999487556, 1.0, 1.0),
            (0.999948341, 1.0, 0.931034483),
            (0.999989856, 1.0, 0.92296405),
            (0.999999739, 1.0, 0.813646368),
            (0.999999998, 1.0, 0.723404255),
        ],
    },
}
