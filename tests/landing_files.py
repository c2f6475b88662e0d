"""CSV landing files shaped like a device group's monthly file."""

import random

HEADER = "timestamp,turbine_id,wind_speed,wind_direction,power_output"


def lines(turbines=(41, 42), days=range(1, 6), seed=3):
    """Hourly readings with empty, NaN and impossible values, and one reading delivered twice."""
    dice = random.Random(seed)
    rows = []
    for day in days:
        for hour in range(24):
            for turbine in turbines:
                speed, direction, power = (
                    f"{dice.uniform(9, 15):.1f}", str(dice.randrange(360)), f"{dice.uniform(1.5, 4.5):.2f}"
                )
                draw = dice.random()
                power = {0: "", 1: "-1.5", 2: "NaN"}.get(int(draw * 60), power)
                speed = {3: "150.0", 4: "-3.2", 5: "NaN", 6: ""}.get(int(draw * 60), speed)
                direction = {7: "400", 8: "-15", 9: ""}.get(int(draw * 60), direction)
                rows.append(f"2022-03-{day:02d} {hour:02d}:00:00,{turbine},{speed},{direction},{power}")
    return rows + [f"2022-03-{days[0]:02d} 05:00:00,{turbines[0]},9.9,99,2.28"]


def write(folder, name, rows, header=HEADER):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(("\r\n".join([header, *rows]) + "\r\n").encode())
