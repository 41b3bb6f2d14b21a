"""Fixed values.

These must equal the values of the repository's own tools for right results:
names, patterns, residue lists, limits.  They are plain lists in natural order.
"""

# Name of the completion marker of an upload.  An entry of the packed ticket
# string is this prefix, the landing id, a colon and the collection.
COMPLETION_MARKER = "mdrepo-submission.completed.json"
TICKET_PREFIX = "MDRSubmit_"

# Queue.
IN_FLIGHT = ["pending", "running"]
MAX_ATTEMPTS = 5
BACKOFF_BASE_MIN = 5
BACKOFF_FACTOR = 4
BACKOFF_CAP_MIN = 180
STUCK_HOURS = 12
RETRYABLE_TEXT = [
    "failed to establish a connection to irods server",
    "networkexception",
    "exec_cmd_error",
]

# Transfers.
MAX_COLLECTIONS_PER_CALL = 25
MAX_OBJECTS_PER_CALL = 100
MEDIA_FILES = ["thumbnail.png", "minimal.pdb", "sampled.xtc"]

# Backups.
EXPECTED_REPLICAS = 2
SNAPSHOT_PREFIX = "backup."
SNAPSHOT_SUFFIX = ".sql.gz"

# Series.
MAX_RMSD = 500
MAX_RMSF = 500
SERIES_POINTS = 1000
SAMPLE_FROM_FRAMES = 1000
SAMPLE_FRAMES = 100

# Logs of ticket runs.
LOG_PREFIX = "ticket-"
LOG_SUFFIX = ".log"

# Import.
ADMIN_ORCID = "0000-0000-0000-0000"
SOLUTE_NAMES = {"Na": "Na+", "Cl": "Cl+", "K": "K+"}

# Software and the file extensions it is expected to bring.
SOFTWARE_EXTENSIONS = {
    "acemd": [".psf", ".xtc", ".pdb"],
    "acemd3": [".psf", ".xtc", ".pdb"],
    "amber": [".prmtop", ".nc", ".inpcrd", ".mdcrd"],
    "charmm": [".psf", ".rtf", ".dcd", ".crd"],
    "desmond": [".cms", ".dtr"],
    "gromacs": [".gro", ".top", ".tpr", ".xtc", ".trr", ".mdp", ".pdb"],
    "lammps": [".data", ".dump"],
    "namd": [".psf", ".pdb", ".dcd"],
}

# Topology formats by extension, first match wins.
FORMAT_EXTENSIONS = {
    "amber": [".prmtop", ".parm7"],
    "namd": [".psf"],
    "charmm": [".rtf", ".prm"],
    "gromacs": [".top", ".tpr", ".gro"],
}

# Reader format by extension for binary files.
READER_FORMATS = {
    "pdb": "PDB",
    "gro": "GRO",
    "top": "ITP",
    "itp": "ITP",
    "tpr": "TPR",
    "psf": "PSF",
    "cif": "MMCIF",
    "mmcif": "MMCIF",
    "prmtop": "TOP",
    "parm7": "TOP",
}
PDB_RECORDS = ["ATOM  ", "HETATM", "HEADER", "CRYST1", "MODEL ", "REMARK", "TITLE ", "COMPND"]
TOPOLOGY_SECTION = r"^\s*\[\s*(defaults|atomtypes|moleculetype|system|molecules)\s*\]"

# Residues that are not a ligand.
AMINO_ACIDS = [
    "ALA", "ARG", "ASN", "ASP", "CYS", "GLN", "GLU", "GLY", "HIS", "ILE", "LEU", "LYS", "MET", "PHE",
    "PRO", "SER", "THR", "TRP", "TYR", "VAL", "HIE", "HID", "HIP", "HSD", "HSE", "HSP", "ASH", "GLH",
    "LYN", "CYM", "CYX",
]
NUCLEOTIDES = [
    "A", "C", "G", "T", "U", "DA", "DC", "DG", "DT", "DU", "RA", "RC", "RG", "RT", "RU", "ADE", "CYT",
    "GUA", "THY", "URA",
]
WATERS = [
    "HOH", "WAT", "H2O", "TIP", "TIP3", "TIP3P", "TIP4", "TIP4P", "TIP5", "SOL", "T3P", "T4P", "SPC",
    "SPCE", "OPC", "IP3", "IP4", "IP5",
]
LIPIDS = [
    "DPPC", "POPC", "DOPC", "DLPC", "DMPC", "DSPC", "POPE", "DPPE", "DOPE", "DLPE", "DMPE", "DSPE",
    "POPG", "DPPG", "DLPG", "DMPG", "DSPG", "DOPS", "DPPS", "DOPA", "CHOL", "CHL1", "CER", "PSM", "DHPC",
    "PPC", "OPE", "LPC", "MPC", "OPG", "PPE", "PPG", "HOL", "HL1", "OPS", "OPA", "HPC",
]
IONS = [
    "NA", "K", "MG", "CA", "CL", "ZN", "FE", "MN", "CU", "BR", "I", "IOD", "LI", "RB", "CS", "F", "CO",
    "NI", "HG", "CD", "BA", "SR", "AL", "SE", "SOD", "POT", "CLA", "MGY",
]

# Residues stripped from the minimal trajectories.
STRIP_WATER = ["WAT", "HOH", "TIP3", "TIP3P", "TIP4", "TIP4P", "TIP5", "OPC", "SPC", "SOL"]
STRIP_IONS = ["NA", "CL", "K", "SOD", "CLA", "NA+", "CL-", "K+", "Mg2+", "MG", "Na+", "Cl-"]
STRIP_LIPIDS = ["DPPC", "POPC", "POPE", "DOPC", "DLPC", "DMPC", "DSPC", "CHOL"]
BACKBONE = ["CA", "C", "N"]

# Residue code to one letter: the standard (extended) alphabet, and variants,
# which go first.  An empty letter drops the residue.
CANONICAL_LETTERS = {
    "ALA": "A", "CYS": "C", "ASP": "D", "GLU": "E", "PHE": "F", "GLY": "G", "HIS": "H", "ILE": "I",
    "LYS": "K", "LEU": "L", "MET": "M", "ASN": "N", "PRO": "P", "GLN": "Q", "ARG": "R", "SER": "S",
    "THR": "T", "VAL": "V", "TRP": "W", "TYR": "Y", "ASX": "B", "XAA": "X", "GLX": "Z", "XLE": "J",
    "SEC": "U", "PYL": "O",
}
VARIANT_LETTERS = {
    "ASH": "D", "GLH": "E", "HID": "H", "HIE": "H", "HIP": "H", "HSD": "H", "HSE": "H", "HSP": "H",
    "CYX": "C", "CYM": "C", "CYN": "C", "CME": "C", "CSO": "C", "CSS": "C", "CSX": "C", "OCS": "C",
    "SEP": "S", "TPO": "T", "PTR": "Y", "MSE": "M", "FME": "M", "KCX": "K", "MLZ": "K", "MLY": "K",
    "M3L": "K", "KPI": "K", "CGU": "E", "PCA": "E", "HIC": "H", "MHO": "M", "OMT": "T", "SME": "M",
    "TYI": "Y", "TYS": "Y", "ACE": "", "NME": "", "NH2": "", "FOR": "", "LYR": "K", "SEC": "U",
    "PYL": "O", "COV": "X", "HRG": "H", "AIB": "A",
}

# Chemical elements; the position is the atomic number.
ELEMENTS = [
    "H", "He", "Li", "Be", "B", "C", "N", "O", "F", "Ne", "Na", "Mg", "Al", "Si", "P", "S", "Cl", "Ar",
    "K", "Ca", "Sc", "Ti", "V", "Cr", "Mn", "Fe", "Co", "Ni", "Cu", "Zn", "Ga", "Ge", "As", "Se", "Br",
    "Kr", "Rb", "Sr", "Y", "Zr", "Nb", "Mo", "Tc", "Ru", "Rh", "Pd", "Ag", "Cd", "In", "Sn", "Sb", "Te",
    "I", "Xe", "Cs", "Ba", "La", "Ce", "Pr", "Nd", "Pm", "Sm", "Eu", "Gd", "Tb", "Dy", "Ho", "Er", "Tm",
    "Yb", "Lu", "Hf", "Ta", "W", "Re", "Os", "Ir", "Pt", "Au", "Hg", "Tl", "Pb", "Bi", "Po", "At", "Rn",
    "Fr", "Ra", "Ac", "Th", "Pa", "U", "Np", "Pu", "Am", "Cm", "Bk", "Cf", "Es", "Fm", "Md", "No", "Lr",
    "Rf", "Db", "Sg", "Bh", "Hs", "Mt", "Ds", "Rg", "Cn", "Nh", "Fl", "Mc", "Lv", "Ts", "Og",
]
ORGANIC_LETTERS = ["H", "C", "N", "O", "P", "S"]

# Names that are registry codes.
CAS_NUMBER = r"^\d{1,7}-\d{1,2}-\d$"
PDB_CODE = r"^\d[A-Za-z0-9]{3}$"
INCHIKEY = r"^[A-Z]{14}-[A-Z]{10}-[A-Z]$"
LABEL_IS_ID = r"^Q\d+$"
PDB_COMPOUND_SOURCE = "5"
