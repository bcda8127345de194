"""Options of a run: defaults, bounds and what is refused."""

from __future__ import annotations

import argparse
from dataclasses import dataclass, fields, replace

# The depths a run may ask for and the bounds of intensity.
MAX_DEPTH = 22
INTENSITY = (1.0, 16.0)
INTERPOLATIONS = ("nearest", "bilinear")
PRIORITIES = ("resolution", "higher")


@dataclass(frozen=True)
class Options:
    """input and output are folders of any store that Spark and Arrow read. max_depth -1 follows from the finest raster."""

    input: str = ""
    output: str = ""
    geoid: str = "Ellipsoid"
    min_depth: int = 0
    max_depth: int = -1
    intensity: float = 4.0
    interpolation: str = "bilinear"
    priority: str = "resolution"
    nodata: float = -9999.0
    mosaic_size: int = 16
    raster_max_size: int = 4096
    calculate_normals: bool = False
    metadata: bool = False
    water_mask: bool = False
    json: bool = False
    resume: bool = False

    def checked(self) -> Options:
        """These options within their bounds. A missing input or output is an error; a least depth over the greatest is 0, as
        is one without a greatest; an unknown interpolation is bilinear, an unknown priority resolution."""
        if not self.input and not self.json:
            raise ValueError("no input folder")
        if not self.output:
            raise ValueError("no output folder")
        clamp = lambda v, low, high: max(low, min(high, v))
        low, high = clamp(self.min_depth, 0, MAX_DEPTH), clamp(self.max_depth, -1, MAX_DEPTH)
        return replace(
            self,
            min_depth=0 if low > high else low,
            max_depth=high,
            intensity=clamp(self.intensity, *INTENSITY),
            interpolation=self.interpolation if self.interpolation in INTERPOLATIONS else "bilinear",
            priority=self.priority.lower() if self.priority.lower() in PRIORITIES else "resolution",
            mosaic_size=max(1, self.mosaic_size),
            raster_max_size=max(64, self.raster_max_size),
        )


# The short names of options.
_SHORT = {"input": "-i", "output": "-o", "geoid": "-g", "min_depth": "-min", "max_depth": "-max", "intensity": "-is", "interpolation": "-it", "priority": "-pt", "nodata": "-nv", "mosaic_size": "-ms", "raster_max_size": "-mr", "calculate_normals": "-cn", "metadata": "-md", "water_mask": "-wm", "json": "-j", "resume": "-c"}
_LONG = {"resume": "--continue", "interpolation": "--interpolationType", "priority": "--priorityType", "nodata": "--nodataValue"}


def parsed(arguments: list[str]) -> Options:
    """Options of a command line, checked."""
    parser = argparse.ArgumentParser(prog="orograph", description="Elevation rasters to a pyramid of terrain tiles.", allow_abbrev=False)
    camel = lambda name: "--" + name.split("_")[0] + "".join(p.title() for p in name.split("_")[1:])
    for f in fields(Options):
        names = [_SHORT[f.name], _LONG.get(f.name, camel(f.name))]
        if isinstance(f.default, bool):
            parser.add_argument(*names, dest=f.name, action="store_true")
        else:
            parser.add_argument(*names, dest=f.name, type=type(f.default), default=f.default)
    return Options(**vars(parser.parse_args(arguments))).checked()
