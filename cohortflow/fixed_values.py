"""Codes, names, formats and settings that outputs must agree on."""

# The analysis type codes.
ANALYSIS_TYPES = ("TF", "TM", "SG", "RP", "RM", "YC", "IM", "BL")

# The two spellings of the upstream pipeline name of each analysis type.
PIPELINE_NAMES = {
    "TF": ("HUMAN_1240K", "Human_1240k"),
    "TM": ("HUMAN_TM", "Human_TM"),
    "SG": ("HUMAN_SHOTGUN", "Human_Shotgun"),
    "RP": ("HUMAN_RP", "Human_RP"),
    "RM": ("HUMAN_RM", "Human_RM"),
    "YC": ("HUMAN_Y", "Human_Y"),
    "IM": ("HUMAN_IM", "Human_IM"),
    "BL": ("BLANKS", "Blanks"),
}

# The result folder that is watched for each analysis type (TM shares the TF folder).
DISCOVERY_FOLDERS = {
    "TF": "Human_1240k",
    "TM": "Human_1240k",
    "SG": "Human_Shotgun",
    "RP": "Human_RP",
    "RM": "Human_RM",
    "YC": "Human_Y",
    "IM": "Human_IM",
    "BL": "Blanks",
}

# Run sheet layout.
SHEET_KEYS = ("analysis_type", "site_id", "target_ind")
SHEET_COLUMNS = (
    "Sample_Name",
    "Library_ID",
    "Lane",
    "Colour_Chemistry",
    "SeqType",
    "Organism",
    "Strandedness",
    "UDG_Treatment",
    "R1",
    "R2",
    "BAM",
)
COLOUR_CHEMISTRY = 4
SEQ_TYPE = "SE"
SHEET_MISSING = "NA"

# Sample metadata layout.
RESULT_COLUMNS = (
    "Sample_Name",
    "Genetic_Sex",
    "Sex_Determination_Note",
    "Nr_SNPs",
    "Endogenous",
    "Contamination",
    "Contamination_Err",
    "Contamination_Note",
    "Contamination_Meas",
    "Damage",
    "UDG",
    "Nr_Libraries",
    "Library_Names",
    "Library_Built",
    "Capture_Type",
)
METADATA_MISSING = "n/a"
CAPTURE_TYPE = "1240K"
CONTAMINATION_SNP_CUTOFF = 100
GENOTYPE_PLOIDY = "haploid"

# Closed ranges (x low, x high, y low, y high) of the X and Y rates of each sex.
XX_CUTOFFS = (0.7, 1.2, 0.0, 0.1)
XY_CUTOFFS = (0.2, 0.6, 0.3, 0.6)

# Sample index layouts, in file order, and their sex codes.
IND_COLUMNS = {
    "EIGENSTRAT": ("Sample_Name", "Genetic_Sex", "Population"),
    "PLINK": ("Population", "Sample_Name", "father", "mother", "sex_code", "case_control"),
}
SEX_OF_CODE = {"1": "M", "2": "F"}
CODE_OF_SEX = {"M": "1", "F": "2"}
SEX_UNKNOWN = "U"
CODE_UNKNOWN = "0"

# Genotype call characters (copies of the reference allele, 9 for missing).
GENOTYPE_CALLS = ("0", "1", "2", "9")
MISSING_CALL = "9"

# Genotype file names that a result folder may hold.
SINGLE_GENOTYPES = "pileupcaller.single.geno"
DOUBLE_GENOTYPES = "pileupcaller.double.geno"

# Result directories that a clean-up keeps, and those a cache clean-up removes.
KEPT_DIRECTORIES = ("work", "1240k.imputed", "GTL_output", "pipeline_info")
WORK_DIRECTORIES = ("work",)

# Read-processing parameters every analysis type starts from.
SHARED_PARAMETERS = {
    "run_bam_filtering": "true",
    "bam_mapping_quality_threshold": "0",
    "bam_unmapped_type": "bam",
    "bam_filter_minreadlength": "30",
    "run_mtnucratio": "true",
    "mtnucratio_header": "MT",
    "run_trim_bam": "true",
    "bamutils_clip_single_stranded_half_udg_left": "0",
    "bamutils_clip_single_stranded_half_udg_right": "0",
    "bamutils_clip_single_stranded_none_udg_left": "0",
    "bamutils_clip_single_stranded_none_udg_right": "0",
    "bamutils_clip_double_stranded_half_udg_left": "2",
    "bamutils_clip_double_stranded_half_udg_right": "2",
    "bamutils_clip_double_stranded_none_udg_left": "7",
    "bamutils_clip_double_stranded_none_udg_right": "7",
    "damage_calculation_tool": "mapdamage",
    "mapdamage_downsample": "100000",
    "genotyping_source": "trimmed",
    "run_genotyping": "true",
    "genotyping_tool": "pileupcaller",
    "pileupcaller_min_map_quality": "25",
    "pileupcaller_min_base_quality": "30",
    "run_sexdeterrmine": "true",
    "run_nuclear_contamination": "true",
    "contamination_chrom_name": "X",
    "run_bedtools_coverage": "true",
}

# What single analysis types change; None is an explicit "no value".
TYPE_PARAMETERS = {
    "SG": {"snpcapture_bed": None},
    "BL": {"snpcapture_bed": None},
    "YC": {"run_genotyping": "false"},
    "IM": {
        "bamutils_clip_single_stranded_half_udg_left": "2",
        "bamutils_clip_single_stranded_half_udg_right": "2",
        "bamutils_clip_single_stranded_none_udg_left": "7",
        "bamutils_clip_single_stranded_none_udg_right": "7",
        "genotyping_tool": "hc",
        "gatk_hc_out_mode": "EMIT_ALL_ACTIVE_SITES",
        "gatk_hc_emitrefconf": "GVCF",
        "run_bcftools_stats": "true",
    },
}

# Shared parameters that single analysis types do not set at all.
TYPE_WITHOUT = {
    "YC": (
        "genotyping_source",
        "genotyping_tool",
        "pileupcaller_min_map_quality",
        "pileupcaller_min_base_quality",
    ),
    "IM": ("pileupcaller_min_map_quality", "pileupcaller_min_base_quality"),
}

# Order in which profiles are laid over each other; the analysis type comes last.
BASE_PROFILES = ("base", "local_paths")

# What the base profile sets for all types.
BASE_PARAMETERS = {"publish_dir_mode": "link"}

# Files whose place a site has to give, and those that single types replace.
SITE_PATHS = (
    "fasta",
    "fasta_index",
    "bwa_index",
    "seq_dict",
    "snpcapture_bed",
    "pileupcaller_bedfile",
    "pileupcaller_snpfile",
    "sexdeterrmine_bedfile",
    "anno_file",
)
TYPE_SITE_PATHS = {"YC": ("snpcapture_bed", "anno_file"), "IM": ("snpcapture_bed", "anno_file")}

# Command of one pending run.
COMMAND = (
    "cd {directory} ; {runner} -r {version} -profile {profiles},{analysis_type} -c {config} "
    "--input {path} --outdir {outdir} -w {outdir}/temp -ansi-log false -resume {extra}"
)

# Wording of notes in the sample metadata.
CONTAMINATION_NOTE = (
    "Nr Snps (per library): ",
    ". Estimate and error are weighted means of values per library."
    " Libraries with fewer than {cutoff} were excluded.",
)
NO_CONTAMINATION_NOTE = "No results found."
SEX_NOTE = "x-rate: %.3f +- %.3f, y-rate: %.3f +- %.3f"
